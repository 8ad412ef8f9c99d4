"""Golden rows: the real report builders over tiny hand-made tables in the
driver schema, with the edge cases the driver data lacks (exact ratio
boundaries, .5 means, fan-out, NULL amounts, ties, empty matches)."""

import datetime as dt
import decimal
import tempfile

import pytest

from quill.plans import listings, sales, stock, summaries, views
from quill.plans.context import Ctx
from quill.sources.schemas import SCHEMAS

D = decimal.Decimal
T0 = dt.datetime


@pytest.fixture(scope="module")
def fx(spark):
    root = tempfile.mkdtemp(prefix="quill-fixture-")
    rows = {
        "region": [(0, "AFRICA"), (1, "AMERICA")],
        "nation": [(0, "NATION_0", 0), (7, "NATION_7", 1)],
        "customer": [
            (1, "Customer#000000001", 0, 4800.00, "BUILDING"),   # exactly 0.8 of 6000
            (2, "Customer#000000002", 0, 4800.01, "BUILDING"),   # just above 0.8
            (3, "Customer#000000003", 7, 3000.00, "BUILDING"),   # exactly 0.5
            (4, "Customer#000000004", 7, 3088.76, "MACHINERY"),
            (5, "Customer#000000005", 7, 3088.77, "MACHINERY"),  # mean .765 → up
            (6, "Customer#000000006", 0, -10.00, "HOUSEHOLD"),
        ],
        "orders": [
            # customer 1: order 10 has 2 lines (fan-out), order 11 has none
            (10, 1, "F", 40000.00, T0(2000, 4, 3), "1-URGENT"),
            (11, 1, "O", 20000.00, T0(2000, 4, 9), "2-HIGH"),
            # customer 2: two orders tied on date; the higher key is latest
            (12, 2, "O", 70000.00, T0(2001, 5, 1), "3-MEDIUM"),
            (13, 2, "P", 70000.00, T0(2001, 5, 1), "3-MEDIUM"),
            # customer 3: a NULL amount ranks last in KEEP (DENSE_RANK LAST)
            (14, 3, "F", None, T0(1995, 1, 2), "5-LOW"),
            (15, 3, "F", 90000.00, T0(1995, 1, 3), "5-LOW"),
        ],
        "lineitem": [
            (10, 1, 1, 1, 1.0, 100.00, 0.10, 0.0, "N", "O", T0(2000, 4, 20)),
            (10, 2, 1, 2, 1.0, 200.00, 0.05, 0.0, "N", "O", T0(2000, 4, 21)),
        ],
        "part": [(1, "hot ring", "Brand#1", "ECONOMY", 10, 900.00),
                 (2, "string", "Brand#1", "SMALL", 20, 950.00)],
        "supplier": [(1, "Supplier#1", 0, 9000.0), (2, "Supplier#2", 7, 9000.0)],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return Ctx(spark, root, store_root=f"{root}/_tables")


def test_credit_status_boundaries(fx):
    got = {r.client: r.credit_status for r in listings.client_credit(fx, credit=6000).collect()}
    assert got["Customer#000000001"] == "regular ($4.800)"
    assert got["Customer#000000002"] == "critical"
    assert got["Customer#000000003"] == "good ($3.000)"
    assert "Customer#000000006" not in got  # no credit line


def test_mean_half_rounds_up(fx):
    got = {(r.category, r.branch): r.mean_balance
           for r in summaries.avg_by_category(fx, min_mean=0).collect()}
    assert got[("industrial", "branch america")] == "$3.089"


def test_cashier_fan_out_and_safe(fx):
    fan = {r.cashier: (r.ticket_count, r.total_sold, r.commission_total)
           for r in sales.cashier_sales(fx, min_total=0).collect()}
    safe = {r.cashier: (r.ticket_count, r.total_sold, r.commission_total)
            for r in sales.cashier_sales_safe(fx, min_total=0).collect()}
    # order 10 (2 lines) counted twice, order 11 (no lines) once; commission 10 + 10
    assert fan["Customer#000000001"] == (3, "$100.000", "$20")
    assert safe["Customer#000000001"] == (2, "$60.000", "$20")


def test_keep_last_null_amount_wins(fx):
    got = {r.c_custkey: (r.best_ticket, r.max_amount) for r in sales.best_ticket(fx).collect()}
    assert got[3] == (14, D(90000))
    assert got[2] == (13, D(70000))


def test_latest_open_tie_break_and_exists(fx):
    got = {r.worker: r.status for r in sales.bonus_tenure(fx).collect()}
    assert got["Customer#000000002"] == "partial"   # order 13 beats 12 on the key
    assert "Customer#000000003" not in got            # no open row at the run date


def test_stock_report_word_prefix(fx):
    got = [r.description for r in listings.stock_report(fx).collect()]
    assert got == ["hot ring"]


def test_fines_empty_when_nothing_late_in_year(fx):
    assert views.view_fines(fx).count() == 0


def test_view_clients_zero_advisories(fx):
    got = {r.company_name: (r.total_advisories, r.client_type, r.benefit)
           for r in views.view_clients(fx, status="F", priority="1-URGENT").collect()}
    assert got["Customer#000000001"] == (1, "frequent client", "no benefit")
    assert got["Customer#000000002"] == (0, "new client", "win client")
    assert got["Customer#000000006"][0] == 0          # no orders at all: kept


def test_payroll_drops_unbanded_and_guards_null_commission(fx):
    got = {r.prof_rut: r for r in stock.payroll(fx).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    r1 = got[1]   # BUILDING: commission NULL → pct NULL, value 0
    assert r1.commission_pct is None and r1.commission_value == D(0)
    assert r1.fee_value == D(480) and r1.mobility_bonus == 1200


@pytest.fixture(scope="module")
def edges(spark):
    """Balances and order totals exactly on the reports' band edges."""
    root = tempfile.mkdtemp(prefix="quill-edges-")
    rows = {
        "region": [(0, "AFRICA")],
        "nation": [(0, "NATION_0", 0)],
        "customer": [(i, f"Customer#{i:09d}", 0, bal, "BUILDING") for i, bal in
                     enumerate([5000.00, 5000.01, 3999.99, 4000.00, 2000.00, 1999.99])],
        # totals chosen so net + 19% VAT lands exactly on / just above an edge
        # total = net + ROUND(net * 0.19)
        "orders": [(1, 0, "F", 84034.00, T0(2000, 5, 1), "1-URGENT"),    # total 100000.00
                   (2, 1, "F", 84034.01, T0(2000, 5, 2), "2-HIGH"),      # total 100000.01
                   (3, 2, "F", 210084.00, T0(2000, 5, 3), "3-MEDIUM"),   # total 250000.00
                   (4, 3, "O", 10.00, T0(1999, 5, 3), "4-NOT SPECIFIED")],
        "lineitem": [], "part": [], "supplier": [],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return Ctx(spark, root, store_root=f"{root}/_tables")


def test_income_band_edges(edges):
    bands = {r.full_name: r.income_band for r in listings.income_bands(edges).collect()}
    assert bands["Customer#000000000"] == "band 2"    # 5000.00: not > 5000, in 4000..5000
    assert bands["Customer#000000001"] == "band 1"    # 5000.01
    assert bands["Customer#000000002"] == "band 3"    # 3999.99
    assert bands["Customer#000000003"] == "band 2"    # 4000.00
    assert bands["Customer#000000004"] == "band 3"    # 2000.00
    assert bands["Customer#000000005"] == "band 4"    # 1999.99


def test_invoice_class_edges(edges):
    got = {r.invoice_no: (r.total_amount, r.amount_class)
           for r in listings.invoice_listing(edges).collect()}
    assert got[1] == ("$100.000", "low")       # total 100000.00 <= 100000
    assert got[2] == ("$100.000", "medium")    # 100000.01: shown rounded, classed exactly
    assert got[3] == ("$250.000", "medium")    # <= 250000
    assert 4 not in got                        # 1999: not last year


def test_tenure_bonus_switch_at_cut(edges):
    rows = {r.worker: r for r in sales.bonus_tenure(edges, tenure_cut=1).collect()}
    # first orders in 2000-05 → 1 whole year at 2001-08-15: 10%; cut 0 → 15%
    assert rows["Customer#000000000"].tenure_years == 1
    assert rows["Customer#000000000"].tenure_bonus == "$500"
    rows0 = {r.worker: r for r in sales.bonus_tenure(edges, tenure_cut=0).collect()}
    assert rows0["Customer#000000000"].tenure_bonus == "$750"


def test_days_between_keeps_fractions_of_a_day(spark):
    from quill.functions.dates import days_between
    df = spark.sql("""SELECT TIMESTAMP_NTZ '2001-01-03 12:00:00' a, TIMESTAMP_NTZ '2001-01-01 00:00:00' b
                      UNION ALL SELECT TIMESTAMP_NTZ '2001-01-01 06:00:00', TIMESTAMP_NTZ '2001-01-01 18:00:00'
                      UNION ALL SELECT TIMESTAMP_NTZ '2001-01-05 00:00:00', TIMESTAMP_NTZ '2001-01-01 00:00:00'
                      UNION ALL SELECT NULL, TIMESTAMP_NTZ '2001-01-01 00:00:00'""")
    got = [r.d for r in df.select(days_between("a", "b").alias("d")).collect()]
    assert [None if d is None else float(d) for d in got] == [2.5, -0.5, 4.0, None]


def test_absent_ticket_keeps_the_worker(ctx):
    from quill.plans.sales import bonus_detail
    got = bonus_detail(ctx).collect()
    absent = [r for r in got if r.ticket_no == "no info"]
    assert absent and len(absent) < len(got)
    assert all(r.amount == "no info" and r.ticket_bonus == "0" and r.sim_ticket for r in absent)
