"""Row order of the sorted reports: the differential check ignores
order, so it is asserted here on raw sort keys joined back by row number."""

import datetime as dt
import decimal

import pytest

from quill.plans import listings, sales, summaries, views


def rows(df):
    return df.collect()


def ordered(values, key):
    keys = [key(v) for v in values]
    return len(values) > 5 and keys == sorted(keys)


def number(text):
    """A formatted amount back as a number."""
    return decimal.Decimal("".join(c for c in text if c.isdigit() or c in "-") or "0")


def desc(text):
    """Sort key for descending text order."""
    return [-ord(c) for c in text] + [0]


def test_income_bands_by_name(ctx):                       # F1: single key
    assert ordered(rows(listings.income_bands(ctx)), lambda r: r.full_name)


def test_stock_report_by_id_descending(ctx):              # F1, descending
    got = [r.part_id for r in rows(listings.stock_report(ctx))]
    assert got == sorted(got, reverse=True) and got


def test_salary_listing_by_city_then_hidden_balance(ctx):  # F2 mixed keys, F5 hidden column
    bal = {r.c_name.upper(): r.c_acctbal for r in ctx.t.customer.collect()}
    assert ordered(rows(listings.salary_listing(ctx)), lambda r: (desc(r.city), bal[r.full_name]))


def test_invoices_latest_and_dearest_first(ctx):          # F2
    o = {r.o_orderkey: r for r in ctx.t.orders.collect()}
    zero = dt.datetime(1970, 1, 1)
    assert ordered(rows(listings.invoice_listing(ctx)),
                   lambda r: (-(o[r.invoice_no].o_orderdate - zero).total_seconds(), -o[r.invoice_no].o_totalprice))


def test_clients_by_alias(ctx):                           # F3: sort by alias
    assert ordered(rows(listings.client_credit(ctx)), lambda r: (r.client, r.masked_id))


def test_categories_by_mean_not_shown(ctx):               # F4 aggregate, F5
    got = rows(summaries.avg_by_category(ctx, min_mean="0"))
    means = [number(r.mean_balance) for r in got]
    assert len(got) > 5 and all(a >= b - 1 for a, b in zip(means, means[1:]))


def test_types_by_ratio(ctx):                             # F4
    got = rows(summaries.avg_ratio_by_type(ctx, having_min=0))
    keys = [(-r.price_per_size, r.type_code) for r in got]
    assert keys == sorted(keys) and keys


def test_cashiers_by_total(ctx):                          # F4
    got = [number(r.total_sold) for r in rows(sales.cashier_sales(ctx))]
    assert got == sorted(got, reverse=True) and len(got) > 3


@pytest.mark.parametrize("report,key", [
    (sales.two_sector_advisers, "adviser_id"), (sales.fee_summary, "prof_id"), (sales.fee_before_after, "prof_id")])
def test_people_by_id(ctx, report, key):
    got = [r[key] for r in rows(report(ctx))]
    assert got == sorted(got) and got


def test_view_is_sorted_by_its_reader(ctx):               # F6
    assert ordered(rows(views.view_readback(ctx)), lambda r: (-r.pct, r.worker))
    assert ordered(rows(views.fines_report(ctx)),
                   lambda r: (r.student, -r.returned_date.toordinal(), r.loan_id, r.loan_line))
