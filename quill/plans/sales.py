"""Sales, fee and bonus reports over customer ⟕ orders ⟕ lineitem
(R2, R3, R10, R11, R12, R13).

Shape used throughout: aggregate the big child table on the join key first
(partial aggregation map-side, so a hot key costs one row per task), then
join the much smaller per-key result to its parent. No report joins raw
line items to customers.
"""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions import (cents, dec, from_units, full_name, grouped, in_month,
                             mean_rounded, money, round0, round_ratio, title_case, years_between)
from quill.functions.case import simple_case
from quill.functions.dates import add_months_year, to_day
from quill.operators import band_join, cond_count, cond_sum, keep_last_key
from quill.operators.mutate import update_from_aggregate
from quill.plans import fixed as FX
from quill.plans.context import Ctx
from quill.plans.people import check_char, open_at, order_profile, person_id, salary
from quill.sources.params import exact, literal_bands
from quill.sources.ranged import RangedTable

D = decimal.Decimal


# -- R2 ---------------------------------------------------------------------
def _line_commissions(lines: DataFrame) -> DataFrame:
    """Per order: number of lines and the sum of line commissions
    (extended price x discount), aggregated before any join. The commission
    is kept exact as a long count of 1/10,000 (cents x hundredths)."""
    return (lines.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(cents("l_extendedprice") * cents("l_discount")).alias("commission_u4")))


def cashier_sales(ctx: Ctx, segment: str = "BUILDING", min_total: int = FX.SALES_MIN_TOTAL,
                  fan_out: bool = True) -> DataFrame:
    """R2: per customer of one segment — ticket count, total sold and total
    commission, kept when the total exceeds ``min_total``.

    ``fan_out=True`` reproduces the reference's chained left joins
    (worker ⟕ tickets ⟕ commissions), where an order with k lines is counted
    and summed k times. It is computed without materialising the fan-out: an
    order joined to its k lines contributes ``k`` (or 1 with no lines) to the
    count and ``k x price`` to the total, which is exactly what the joined
    rows would add. ``fan_out=False`` counts each order once.

    Only the segment's customers, their orders and these orders' lines are
    shuffled: semi joins run before the aggregations.
    """
    c = ctx.t.customer.filter(F.col("c_mktsegment") == segment)
    orders = (ctx.t.orders.join(c.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
              .select("o_orderkey", "o_custkey", cents("o_totalprice").alias("price_c")))
    lines = ctx.t.lineitem.join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"),
                                "left_semi")
    per_order = orders.join(_line_commissions(lines), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    mult = F.coalesce(F.col("n_lines"), F.lit(1)) if fan_out else F.lit(1)
    per_cust = (per_order.groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(F.sum(mult).alias("ticket_count"),
                     F.sum(F.col("price_c") * mult).alias("total_c"),
                     F.sum("commission_u4").alias("commission_u4")))
    j = (c.join(ctx.t.nation, c.c_nationkey == F.col("n_nationkey"))
         .join(per_cust, "c_custkey", "left")
         .filter(F.coalesce(F.col("total_c"), F.lit(0)) > F.lit(exact(min_total)) * 100))
    return (j.orderBy(F.col("total_c").desc_nulls_first(), "c_custkey")
            .select(person_id().alias("national_id"), title_case("c_name").alias("cashier"),
                    F.col("c_mktsegment").alias("worker_type"), F.col("n_name").alias("city"),
                    F.coalesce(F.col("ticket_count"), F.lit(0)).cast("long").alias("ticket_count"),
                    money(round_ratio("total_c", F.lit(100))).alias("total_sold"),
                    money(round_ratio(F.coalesce(F.col("commission_u4"), F.lit(0)), F.lit(10_000)))
                    .alias("commission_total")))


def cashier_sales_safe(ctx: Ctx, **kw) -> DataFrame:
    """R2, each order counted once (no fan-out double counting)."""
    return cashier_sales(ctx, fan_out=False, **kw)


# -- R3 ---------------------------------------------------------------------
STATUS_LABELS = {"F": "finished", "O": "open", "P": "partial"}


def bonus_tenure(ctx: Ctx, urgent: str = "1-URGENT", health_name: str = "NATION_7",
                 tenure_cut: int = 5, valid_days: int = 730) -> DataFrame:
    """Per customer with an open status row at the run date: hire year
    and whole years since the first order, dependants (urgent orders, 0 if
    none), nation as health system with a 1% bonus for one of them, tenure
    bonus 10%/15%, region as pension fund and the latest open status.

    Status history = orders: an order's status is valid from its date until
    ``valid_days`` later, or open-ended while the order is open (``O``). The
    latest open row, the dependants count and the first-order date all come
    from ONE aggregation of ``orders`` by customer; EXISTS(open row) is the
    inner join on that aggregate's non-NULL latest row.
    """
    o = ctx.t.orders
    is_open = open_at(ctx.as_of, valid_days)
    # day and key of the latest open row, packed into one number: a fixed-width
    # buffer keeps both phases hash aggregates; the key then fetches the status
    day = F.coalesce(F.unix_date(to_day("o_orderdate")) + 10_000_000, F.lit(0)).cast("decimal(8,0)")
    packed = day * F.lit(D(10) ** 19) + F.col("o_orderkey").cast("decimal(19,0)")
    latest = F.max(F.when(is_open, packed.cast("decimal(38,0)")))
    prof = order_profile(o, [cond_count(F.col("o_orderpriority") == urgent).alias("dependants"),
                             latest.alias("latest_open")])
    prof = prof.filter(F.col("latest_open").isNotNull())
    key = (F.col("latest_open") % F.lit(D(10) ** 19)).cast("long")
    rows = o.filter(is_open).select(F.col("o_orderkey").alias("status_key"), F.col("o_orderstatus").alias("open_status"))
    prof = prof.withColumn("status_key", key).join(rows, "status_key")
    status = F.col("open_status")
    c = ctx.t.customer.join(prof, "c_custkey")
    c = (c.join(ctx.t.nation, c.c_nationkey == F.col("n_nationkey"), "left")
         .join(ctx.t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    sal = salary()
    tenure = years_between(ctx.as_of, "first_order")
    low, high = FX.TENURE_BONUS_RATES
    rate = F.when(tenure <= tenure_cut, F.lit(D(low))).otherwise(F.lit(D(high)))
    return (c.orderBy("c_custkey").select(
        person_id().alias("national_id"),
        title_case("c_name").alias("worker"),
        F.date_format("first_order", "yyyy").alias("hire_year"),
        tenure.alias("tenure_years"),
        F.coalesce(F.col("dependants"), F.lit(0)).cast("long").alias("dependants"),
        F.col("n_name").alias("health_system"),
        money(sal).alias("base_salary"),
        F.when(F.upper("n_name") == health_name,
               money(round0(sal * F.lit(D(FX.HEALTH_BONUS_RATE)))))
        .otherwise(F.lit("$0")).alias("health_bonus"),
        money(round0(sal * rate)).alias("tenure_bonus"),
        F.col("r_name").alias("pension_fund"),
        simple_case(status, STATUS_LABELS, "unknown").alias("status")))


# -- R10 --------------------------------------------------------------------
def two_sector_advisers(ctx: Ctx, a: str = "F", b: str = "O") -> DataFrame:
    """Customers having orders of status ``a`` AND of status ``b`` (the
    reference's ``IN (… INTERSECT …)``), with per-status counts and sums.

    The intersect is folded into the same aggregation: one pass groups orders
    by customer computing every conditional count/sum, and the membership
    test is ``count_a > 0 AND count_b > 0``.
    """
    st, price = F.col("o_orderstatus"), cents("o_totalprice")
    g = (ctx.t.orders.filter(st.isin(a, b)).groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(cond_count(st == a).alias("count_a"), cond_sum(st == a, price).alias("_sum_a"),
              cond_count(st == b).alias("count_b"), cond_sum(st == b, price).alias("_sum_b"),
              F.count(F.lit(1)).alias("count_total"), F.sum(price).alias("_sum_total"))
         .filter((F.col("count_a") > 0) & (F.col("count_b") > 0)))
    j = ctx.t.customer.join(g, "c_custkey")
    return (j.orderBy("c_custkey").select(
        F.col("c_custkey").alias("adviser_id"), F.col("c_name").alias("adviser"),
        F.col("count_a"), money(round_ratio("_sum_a", F.lit(100))).alias("total_a"),
        F.col("count_b"), money(round_ratio("_sum_b", F.lit(100))).alias("total_b"),
        F.col("count_total"), money(round_ratio("_sum_total", F.lit(100))).alias("total_fees")))


# -- R11 --------------------------------------------------------------------
def _served_nations(ctx: Ctx, min_balance=FX.SUPPLIER_MIN_BALANCE) -> DataFrame:
    """Nations with a supplier above a balance: joined only to restrict rows."""
    s = ctx.t.supplier.filter(F.col("s_acctbal") > F.lit(exact(min_balance)).cast("double"))
    return s.select(F.col("s_nationkey").alias("served"))


def fee_summary(ctx: Ctx, month: int = 4) -> DataFrame:
    """Per customer with orders in ``month`` of the year of
    ADD_MONTHS(run date, -12): count, sum, mean, min and max as money; only
    customers in a nation that a well-funded supplier serves (C12: a join
    that projects nothing is a semi join)."""
    year = add_months_year(ctx.as_of, -12)
    o = ctx.t.orders.filter(in_month("o_orderdate", year, month))
    g = (o.groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("fee_count"),
              F.sum(cents("o_totalprice")).alias("_cents"),
              F.count("o_totalprice").alias("_n"),
              F.min(dec("o_totalprice")).alias("_min"), F.max(dec("o_totalprice")).alias("_max")))
    c = ctx.t.customer.join(_served_nations(ctx), F.col("c_nationkey") == F.col("served"), "left_semi")
    j = c.join(g, "c_custkey").join(ctx.t.nation, c.c_nationkey == F.col("n_nationkey"))
    return (j.orderBy("c_custkey").select(
        F.col("c_custkey").alias("prof_id"), F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("profession"), F.col("n_name").alias("district"),
        F.col("fee_count").cast("long").alias("fee_count"),
        money(round_ratio("_cents", F.lit(100))).alias("fee_total"),
        money(mean_rounded(F.col("_cents"), F.col("_n"))).alias("fee_mean"),
        money(F.col("_min")).alias("fee_min"), money(F.col("_max")).alias("fee_max")))


def ctas_fee_summary(ctx: Ctx) -> DataFrame:
    """R11 as ``DROP TABLE; CREATE TABLE … AS SELECT``; then ``SELECT *``."""
    return ctx.store.create_as(fee_summary(ctx), "fee_summary")


# -- R12 --------------------------------------------------------------------
def _month_fees(ctx: Ctx, month: int) -> DataFrame:
    year = add_months_year(ctx.as_of, -12)
    o = ctx.t.orders.filter(in_month("o_orderdate", year, month))
    return o.groupBy(F.col("o_custkey").alias("fee_key")).agg(
        from_units(F.sum(cents("o_totalprice"))).alias("fee_sum"))


def raise_salaries(ctx: Ctx, staff: DataFrame, month: int = 3, threshold: int = 240_000,
                   low_rate: str = FX.SALARY_RAISE_RATES[0],
                   high_rate: str = FX.SALARY_RAISE_RATES[1]) -> DataFrame:
    """The UPDATE: salary x ``low_rate`` when the month's fee sum is below
    ``threshold``, else x ``high_rate`` (a NULL sum falls to the else arm),
    rounded; only for staff with fees that month (EXISTS)."""
    return update_from_aggregate(staff, "c_custkey", _month_fees(ctx, month), "fee_key",
                                 _raise(threshold, low_rate, high_rate))


def _raise(threshold: int = 240_000, low_rate: str = FX.SALARY_RAISE_RATES[0],
           high_rate: str = FX.SALARY_RAISE_RATES[1]) -> dict:
    factor = F.when(F.col("fee_sum") < F.lit(exact(threshold)), F.lit(exact(low_rate))).otherwise(F.lit(exact(high_rate)))
    return {"salary": round0(F.col("salary") * factor)}


def staff_table(ctx: Ctx) -> DataFrame:
    return ctx.t.customer.select("c_custkey", salary().alias("salary"))


def update_by_aggregate_ranged(ctx: Ctx, month: int = 3, ranges: int = 16) -> DataFrame:
    """A13 on a table cut into key ranges: the month's fee keys name the ranges to
    read and write again."""
    t = RangedTable(ctx.store, "staff_ranged", "c_custkey")
    t.create(staff_table(ctx), ranges)
    return t.update_from_aggregate(_month_fees(ctx, month), "fee_key", _raise())


def update_by_aggregate(ctx: Ctx) -> DataFrame:
    """Commit the raised salaries as the next version of the staff
    table (write new version, then read it), starting from a fresh copy."""
    ctx.store.create_as(staff_table(ctx), "staff")
    return ctx.store.replace_with(lambda cur: raise_salaries(ctx, cur), "staff")


def fee_before_after(ctx: Ctx, month: int = 3, threshold: int = 240_000,
                     low_rate: str = FX.SALARY_RAISE_RATES[0],
                     high_rate: str = FX.SALARY_RAISE_RATES[1]) -> DataFrame:
    """The before/after report around the salary update, side by side.

    The staff table is created, updated, and read back: ``salary_after`` comes
    from the committed table, not from the update's formula. Staff with fees
    that month are listed."""
    store, name = ctx.store, "staff_fees"
    fees = store.create_as(_month_fees(ctx, month), "month_fees")       # aggregated once, used by both
    before = store.create_as(staff_table(ctx), name)
    after = store.replace_with(lambda cur: update_from_aggregate(cur, "c_custkey", fees, "fee_key",
                                                                 _raise(threshold, low_rate, high_rate)), name)
    j = (fees.withColumnRenamed("fee_key", "c_custkey")
         .join(before.withColumnRenamed("salary", "old"), "c_custkey")
         .join(after.withColumnRenamed("salary", "new"), "c_custkey"))
    return (j.orderBy("c_custkey").select(
        F.col("c_custkey").alias("prof_id"), F.col("c_custkey").alias("id_number"),
        money(F.col("fee_sum")).alias("fee_total"),
        money(F.col("old")).alias("salary_before"), money(F.col("new")).alias("salary_after")))


# -- R13 --------------------------------------------------------------------
# Tenure bands for the bonus simulation (years low, years high, rate).
TENURE_BANDS = [(0, 2, "0.02"), (3, 5, "0.04"), (5, 6, "0.07")]


def _ticket_amount(grain: int):
    return (F.floor(dec("o_totalprice") / grain) * grain).cast("decimal(18,0)")


def best_ticket(ctx: Ctx, grain: int = 10_000, tickets: DataFrame | None = None) -> DataFrame:
    """Per customer: the largest ticket amount (order price floored to
    ``grain``, so equal amounts occur) and MAX(order) KEEP (DENSE_RANK LAST
    ORDER BY amount)."""
    amount = _ticket_amount(grain)
    tickets = ctx.t.orders if tickets is None else tickets
    return tickets.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(amount).alias("max_amount"), keep_last_key("o_orderkey", amount).alias("best_ticket"))


def bonus_detail(ctx: Ctx, bands=TENURE_BANDS, ticket_status: str = "F",
                 ticket_priority: str = "1-URGENT") -> DataFrame:
    """R13 select: customer ⋈ nation ⋈ region ⋈ tenure band (range join on
    whole years since the first order) ⟕ best ticket, restricted to served
    nations (C12). Tickets are the finished urgent orders, a source of their
    own: a customer without any stays, with 'no info' as ticket and amount.
    Bonus 7% above 100,000, 5% above 50,000, else 0 — an absent ticket yields
    0, not the text (the reference's NVL there is dead)."""
    hired = order_profile(ctx.t.orders).select("c_custkey", "first_order")
    tickets = ctx.t.orders.filter((F.col("o_orderstatus") == ticket_status)
                                  & (F.col("o_orderpriority") == ticket_priority))
    c = (ctx.t.customer.join(hired, "c_custkey")
         .join(_served_nations(ctx), F.col("c_nationkey") == F.col("served"), "left_semi")
         .join(ctx.t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(ctx.t.region, F.col("n_regionkey") == F.col("r_regionkey"))
         .withColumn("tenure", years_between(ctx.as_of, "first_order")))
    tbl, st = literal_bands(ctx.spark, bands)
    c = band_join(c, F.col("tenure"), tbl, stats=st).join(best_ticket(ctx, tickets=tickets), "c_custkey", "left")
    sal, amt = salary(), F.col("max_amount")
    (hi_min, hi_rate), (mid_min, mid_rate) = FX.TICKET_BONUS_HIGH, FX.TICKET_BONUS_MID
    bonus = (F.when(amt > hi_min, amt * F.lit(D(hi_rate)))
             .when((amt > mid_min) & (amt <= hi_min), amt * F.lit(D(mid_rate)))
             .otherwise(F.lit(0)))
    return c.select(
        "c_custkey", F.col("lo").alias("band_lo"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("-"), check_char()).alias("rut"),
        title_case("c_name").alias("worker_name"),
        grouped(sal).alias("base_salary"),
        F.coalesce(F.col("best_ticket").cast("string"), F.lit("no info")).alias("ticket_no"),
        F.col("n_name").alias("address"),
        full_name("r_name", "n_name").alias("health_system"),
        F.coalesce(grouped(amt), F.lit("no info")).alias("amount"),
        F.coalesce(grouped(round0(bonus)), F.lit("no info")).alias("ticket_bonus"),
        grouped(round0(sal + bonus)).alias("sim_ticket"),
        grouped(round0(sal * (F.lit(1) + F.col("rate")))).alias("sim_tenure"))


BONUS_DETAIL_SCHEMA = T.StructType([
    T.StructField("num", T.LongType()), T.StructField("rut", T.StringType()),
    T.StructField("worker_name", T.StringType()), T.StructField("base_salary", T.StringType()),
    T.StructField("ticket_no", T.StringType()), T.StructField("address", T.StringType()),
    T.StructField("health_system", T.StringType()), T.StructField("amount", T.StringType()),
    T.StructField("ticket_bonus", T.StringType()), T.StructField("sim_ticket", T.StringType()),
    T.StructField("sim_tenure", T.StringType())])


def append_bonus_detail(ctx: Ctx, start: int = 1) -> DataFrame:
    """``INSERT INTO detail SELECT seq.NEXTVAL, …`` into a freshly
    created (empty) table, then ``SELECT *``. Keys follow worker order; rows
    duplicated by overlapping bands get consecutive keys."""
    ctx.store.create_empty("bonus_detail", BONUS_DETAIL_SCHEMA)
    return ctx.store.append_keyed(bonus_detail(ctx), "bonus_detail", key="num",
                                  order=["c_custkey", "band_lo"], start=start)


def keep_last_ticket(ctx: Ctx) -> DataFrame:
    """D14 on its own: per customer, best ticket by KEEP (DENSE_RANK LAST)."""
    return best_ticket(ctx)
