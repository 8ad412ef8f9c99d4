"""Named views and their read-backs.

A view is a function returning a DataFrame plus ``createOrReplaceTempView``:
the stored logical plan is inlined by the analyzer when read, so the reader
gets the same pushdown and pruning as if it had written the query itself.
Ordering inside a view is not a guarantee after a shuffle, so views are
unsorted and readers sort.
"""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions import (dec, full_name, in_year, money, round0, title_case,
                             years_between)
from quill.functions.dates import days_between, to_day, ts_lit, year_bounds
from quill.operators.skew import salted_join
from quill.plans import fixed as FX
from quill.plans.context import Ctx
from quill.plans.people import check_char, order_profile, person_id, salary
from quill.sources.catalog import Database

D = decimal.Decimal

# Schooling bonus by region: region key → (level, percent). Region 4 has no
# entry, so its customers drop out of the inner join, as in the reference.
SCHOOL_BONUS = {0: ("primary", 4), 1: ("secondary", 6), 2: ("technical", 8),
                3: ("university", 10)}


def _school_table(ctx: Ctx) -> DataFrame:
    schema = T.StructType([T.StructField("school_key", T.IntegerType()),
                           T.StructField("level", T.StringType()),
                           T.StructField("pct", T.IntegerType())])
    return ctx.spark.createDataFrame([(k, v[0], v[1]) for k, v in SCHOOL_BONUS.items()], schema)


def view_raises(ctx: Ctx, urgent: str = "1-URGENT", name: str = "v_raises") -> DataFrame:
    """Raise by schooling level (region), with the dependants count
    (urgent orders; 0 when none — the left join keeps those workers).

    The reference groups the joined rows; here the child side (orders) is
    counted per customer first, then joined 1:1 — same rows, no fan-out."""
    deps = (ctx.t.orders.filter(F.col("o_orderpriority") == urgent)
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.count("o_orderkey").alias("dependants")))
    c = ctx.t.customer
    j = (c.join(ctx.t.nation, c.c_nationkey == F.col("n_nationkey"))
         .join(F.broadcast(_school_table(ctx)), F.col("n_regionkey") == F.col("school_key"))
         .join(deps, "c_custkey", "left"))
    sal = salary()
    pct = F.col("pct").cast("decimal(5,0)")
    v = j.select(
        F.concat(F.col("c_custkey").cast("string"), F.lit("-"), check_char()).alias("rut"),
        title_case("c_name").alias("worker"),
        F.col("level").alias("level"), F.col("pct").alias("pct"),
        sal.alias("salary"),
        round0(sal * (pct * F.lit(D(FX.PERCENT)))).alias("raise_amount"),
        round0(sal * (F.lit(1) + pct * F.lit(D(FX.PERCENT)))).alias("raised_salary"),
        F.coalesce(F.col("dependants"), F.lit(0)).cast("long").alias("dependants"),
        F.col("n_name").alias("city"), F.col("c_mktsegment").alias("contract_type"))
    v.createOrReplaceTempView(name)
    return ctx.spark.table(name)


def view_readback(ctx: Ctx) -> DataFrame:
    """A10: another reader selects a column subset of the view, sorted."""
    view_raises(ctx)
    return (ctx.spark.table("v_raises")
            .select("rut", "worker", "level", "pct", "salary", "raise_amount", "raised_salary")
            .orderBy(F.col("pct").desc_nulls_first(), F.col("worker").asc_nulls_last()))


# Careers (segments) whose fines get a 20% rebate.
REBATE_CAREERS = ["AUTOMOBILE", "FURNITURE"]


def _late_loans(ctx: Ctx, years_back: int = 2, salts: int = 0) -> DataFrame:
    """Loans (line items) due (ordered) in year(run date) - ``years_back`` and
    returned (shipped) after the due day, with student, career and book.

    ``ship > order >= Jan 1`` implies ``ship >= Jan 1``: that derived bound
    is added so the line-item scan is pruned too (Catalyst does not infer
    it from the column-to-column comparison).

    Row-level joins cannot be pre-aggregated: a hot order, customer or part is
    left to AQE's skew-join splitting, or (``salts`` > 0, for sessions without
    AQE) every key is spread over that many tasks by the line item's own key."""
    year = ctx.as_of.year - years_back
    lo, _ = year_bounds(year)
    o = ctx.t.orders.filter(in_year("o_orderdate", year)).select("o_orderkey", "o_custkey", "o_orderdate")
    li = (ctx.t.lineitem.filter(F.col("l_shipdate") > ts_lit(lo))
          .select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"))
    c = ctx.t.customer.select("c_custkey", "c_name", "c_mktsegment")
    p = ctx.t.part.select("p_partkey", "p_retailprice")

    def meet(big: DataFrame, small: DataFrame, key: str, small_key: str) -> DataFrame:
        if not salts:
            return big.join(small, F.col(key) == F.col(small_key))
        out = salted_join(big, small.withColumnRenamed(small_key, key), [key],
                          salt_on=["l_orderkey", "l_linenumber"], salts=salts)
        return out.withColumn(small_key, F.col(key))

    j = meet(li, o, "l_orderkey", "o_orderkey").filter(F.col("l_shipdate") > F.col("o_orderdate"))
    return meet(meet(j, c, "o_custkey", "c_custkey"), p, "l_partkey", "p_partkey")


def _fine_columns(rebate: bool, rate: str = FX.FINE_RATE_PER_DAY,
                  rebate_pct: int = FX.FINE_REBATE_PCT):
    price = dec("p_retailprice")
    # date minus date keeps the fraction of a day; the fine is on the exact days
    days = days_between("l_shipdate", "o_orderdate")
    fine = days * (price * F.lit(D(rate)))
    cols = [F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("loan_line"),
            full_name("c_name", "c_mktsegment").alias("student"),
            F.col("c_mktsegment").alias("career"), F.col("p_partkey").alias("book_id"),
            price.alias("book_price"), to_day("o_orderdate").alias("due_date"),
            to_day("l_shipdate").alias("returned_date"), days.alias("days_late"),
            round0(fine).alias("fine")]
    if rebate:
        # Percentage compares the raw text; the amount compares upper/trim —
        # two tests, as in the reference (they can disagree on mixed case).
        in_raw = F.col("c_mktsegment").isin(REBATE_CAREERS)
        in_norm = F.upper(F.trim("c_mktsegment")).isin([c.upper() for c in REBATE_CAREERS])
        cols += [F.when(in_raw, F.lit(rebate_pct)).otherwise(F.lit(0)).alias("rebate_pct"),
                 round0(fine * (F.lit(1) - F.when(in_norm, F.lit(D(rebate_pct) / 100))
                                .otherwise(F.lit(D(0))))).alias("rebated_fine"),
                 # audit column: do the two tests agree on this row?
                 (F.coalesce(in_raw, F.lit(False)) == F.coalesce(in_norm, F.lit(False)))
                 .alias("rebate_consistent")]
    return cols


def view_fines(ctx: Ctx, name: str = "v_fines_detail", salts: int = 0) -> DataFrame:
    """Fines detail view (3% of the book price per late day, rebate)."""
    _late_loans(ctx, salts=salts).select(*_fine_columns(True)).createOrReplaceTempView(name)
    return ctx.spark.table(name)


def view_fines_salted(ctx: Ctx, salts: int = 4) -> DataFrame:
    """R16 for sessions without AQE: every join key spread by salting."""
    return view_fines(ctx, name="v_fines_detail_salted", salts=salts)


def fines_report(ctx: Ctx) -> DataFrame:
    """the sorted read of the fines view (the order belongs to the reader):
    by student, then the latest return first."""
    view_fines(ctx)
    return (ctx.spark.table("v_fines_detail")
            .select("student", "career", "loan_id", "loan_line", "returned_date", "days_late", "rebated_fine")
            .orderBy(F.col("student").asc_nulls_last(), F.col("returned_date").desc_nulls_first(),
                     "loan_id", "loan_line"))


def view_fines_brief(ctx: Ctx, name: str = "v_fines") -> DataFrame:
    """The same without the rebate columns."""
    _late_loans(ctx).select(*_fine_columns(False)).createOrReplaceTempView(name)
    return ctx.spark.table(name)


def view_clients(ctx: Ctx, status: str = "P", priority: str = "1-URGENT",
                 refund_years: int = 2, free_years: int = 6, name: str = "v_clients"
                 ) -> DataFrame:
    """Client companies with years of activity (since the first order),
    count of advisories (orders of one status AND priority — restricted in
    the join so companies with none show 0), VAT refund after
    ``refund_years``, client type by count and the benefit that applies."""
    adv = F.when((F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority),
                 F.col("o_orderkey"))
    prof = order_profile(ctx.t.orders, [F.count(adv).alias("advisories")])
    c = ctx.t.customer.join(prof, "c_custkey", "left")
    years = years_between(ctx.as_of, "first_order")
    n = F.coalesce(F.col("advisories"), F.lit(0))
    v = c.select(
        person_id().alias("company_id"), F.col("c_name").alias("company_name"),
        F.lit(FX.VAT_TEXT).alias("vat"), years.alias("years_active"),
        n.cast("long").alias("total_advisories"),
        F.when(years >= refund_years,
               money(round0(salary() * F.lit(D(FX.VAT_REFUND_RATE))), symbol_in_mask=True))
        .otherwise(F.lit("$0")).alias("vat_refund"),
        F.when(n >= FX.MAJOR_CLIENT_MIN, "major client")
        .when(n.between(1, FX.MAJOR_CLIENT_MIN - 1), "frequent client")
        .otherwise("new client").alias("client_type"),
        F.when(years >= free_years, "free advisory").when(n == 0, "win client")
        .otherwise("no benefit").alias("benefit"))
    v.createOrReplaceTempView(name)
    return ctx.spark.table(name)


def define_status_views(ctx: Ctx, valid_days: int = 730) -> Database:
    """Catalog definitions over the input tables: a view of order days, and the
    status that is valid at a run date (E1) as a function of that date."""
    db = Database.over(ctx.spark, ctx.root)
    db.define_tables(ctx.t, ["orders", "customer"])
    db.define_view("order_days", "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, "
                                 f"to_date(o_orderdate) AS order_day FROM {db.name}.orders")   # not a temporary view
    db.define_function(
        "status_at", {"run_date": "DATE"},
        "o_custkey BIGINT, o_orderkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
        f"""SELECT o_custkey, last.o_orderkey, last.o_orderstatus, last.o_orderdate
            FROM (SELECT o_custkey, max(struct(o_orderdate, o_orderkey, o_orderstatus)) AS last FROM {db.name}.order_days
                  WHERE o_orderstatus = 'O' OR o_orderdate IS NULL
                     OR o_orderdate >= CAST(date_sub(run_date, {valid_days - 1}) AS TIMESTAMP_NTZ)
                  GROUP BY o_custkey)""")
    return db


def status_at_run_date(ctx: Ctx) -> DataFrame:
    """Defined in this session, read by another one with its run date."""
    name = define_status_views(ctx).name
    return Database(ctx.spark.newSession(), name).call("status_at", ctx.as_of)
