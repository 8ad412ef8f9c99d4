"""Copy stock control (R18), payroll statement (R20), product link update."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions import dec, in_year, round0, round_ratio
from quill.functions.case import simple_case
from quill.operators import band_join, update_where
from quill.operators.sketches import distinct_sketches, merged_distinct
from quill.plans import fixed as FX
from quill.plans.context import Ctx
from quill.sources.params import literal_bands
from quill.sources.ranged import RangedTable

D = decimal.Decimal


# -- R18 --------------------------------------------------------------------
def stock_control(ctx: Ctx, suppliers=(1, 5, 9), years_back: int = 2) -> DataFrame:
    """Per book (part) — copies, copies on loan, available, percentage
    on loan and a flag that is 'S' when more than two copies are free.

    Copies are line items identified by (order, line number) — not unique,
    hence COUNT(DISTINCT). Loans are line items of the same copy key shipped
    in year(run date) - ``years_back`` by one of ``suppliers``; the reference
    puts those predicates in the ON clause of a LEFT JOIN so books without
    loans survive with 0.

    Plan: (part, copy) pairs are de-duplicated first — a partial aggregate,
    so a copy key repeated across a third of the rows collapses map-side;
    the matched copy keys are one filtered, de-duplicated key set; the
    de-duplicated pairs are tagged by a left join on that set (1:1, no
    fan-out, no hot key left) and a second aggregate counts per part. Two
    plain aggregations replace the two COUNT(DISTINCT)s (no Expand).
    """
    li = ctx.t.lineitem
    loans = (li.filter(in_year("l_shipdate", ctx.as_of.year - years_back)
                       & F.col("l_suppkey").isin(list(suppliers)))
             .select(F.col("l_orderkey").alias("lk_o"), F.col("l_linenumber").alias("lk_l"))
             .distinct())
    copies = li.select("l_partkey", "l_orderkey", "l_linenumber").distinct()
    tagged = copies.join(loans, (F.col("l_orderkey") == F.col("lk_o"))
                         & (F.col("l_linenumber") == F.col("lk_l")), "left")
    per_book = (tagged.groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("total_copies"), F.count("lk_o").alias("on_loan")))
    return _stock_columns(ctx, per_book)


def _stock_columns(ctx: Ctx, per_book: DataFrame) -> DataFrame:
    j = ctx.t.part.join(per_book, F.col("p_partkey") == F.col("l_partkey"))
    total, out = F.col("total_copies"), F.col("on_loan").cast("long")
    return j.select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("book_name"),
        total.cast("long").alias("total_copies"), out.alias("on_loan"),
        (total - out).cast("long").alias("available"),
        round_ratio(out * 100, total).alias("loan_pct"),
        F.when(total - out > 2, "S").otherwise("N").alias("enough_stock"))


def ctas_stock(ctx: Ctx) -> DataFrame:
    """R18 as ``DROP TABLE … ; CREATE TABLE … AS SELECT``, then read back."""
    return ctx.store.create_as(stock_control(ctx), "stock_control", sort_within=["book_id"])


def approx_distinct(ctx: Ctx, years_back: int = 4, within: float = 0.03) -> DataFrame:
    """D3, opt-in: customers per brand over the last ``years_back`` years from stored
    sketches per brand and year, beside the exact count. Which estimates are
    more than ``within`` off is part of the report: none."""
    rows = (ctx.t.lineitem.join(ctx.t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(ctx.t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select("p_brand", F.year("l_shipdate").alias("year"), "o_custkey"))
    saved = ctx.store.create_as(distinct_sketches(rows, ["p_brand", "year"], "o_custkey"), "brand_sketches")
    first = ctx.as_of.year - years_back
    estimate = merged_distinct(saved.filter(F.col("year") >= first), ["p_brand"])
    exact = rows.filter(F.col("year") >= first).groupBy("p_brand").agg(F.count_distinct("o_custkey").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers")) > F.col("customers") * F.lit(within)
    return exact.join(estimate, "p_brand").select("p_brand", "customers", off.alias("off"))


# -- R20 --------------------------------------------------------------------
# Contract by segment: (contract name, incentive, commission fraction or None).
CONTRACTS = {"AUTOMOBILE": ("full-time permanent", 900, "0.05"),
             "BUILDING": ("part-time permanent", 700, None),
             "FURNITURE": ("fixed term", 400, "0.03"),
             "HOUSEHOLD": ("fee based", 300, "0.02"),
             "MACHINERY": ("seasonal", 250, "0.04")}
# Mobility bonus by contract name; any other contract gets its incentive.
MOBILITY = {"full-time permanent": 1500, "part-time permanent": 1200, "fixed term": 600,
            "fee based": 500}
# Salary bands (min, max, fee percent); balances of 9,000 and above are in
# no band and drop out, as a value outside every band does in the reference.
SALARY_BANDS = [(-1000, "1999.99", "5"), (2000, "5999.99", "10"), (6000, "8999.99", "15")]


def _contract_table(ctx: Ctx) -> DataFrame:
    schema = T.StructType([T.StructField("seg", T.StringType()),
                           T.StructField("contract", T.StringType()),
                           T.StructField("incentive", T.IntegerType()),
                           T.StructField("commission", T.DecimalType(4, 2))])
    rows = [(k, v[0], v[1], D(v[2]) if v[2] else None) for k, v in CONTRACTS.items()]
    return ctx.spark.createDataFrame(rows, schema)


def payroll(ctx: Ctx) -> DataFrame:
    """Pay statement — salary, commission (NULL-guarded in the amount,
    not in the percentage), fee by salary band (range join), mobility bonus
    by contract, and the rounded total."""
    c = (ctx.t.customer
         .join(ctx.t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(F.broadcast(_contract_table(ctx)), F.col("c_mktsegment") == F.col("seg")))
    bands, st = literal_bands(ctx.spark, SALARY_BANDS, edge_type=T.DecimalType(18, 2),
                              rate_type=T.DecimalType(5, 2))
    c = band_join(c, dec("c_acctbal"), bands, stats=st)
    sal = dec("c_acctbal")
    comm = F.coalesce(F.col("commission"), F.lit(D(0)))
    bonus = simple_case(F.col("contract"), MOBILITY, F.col("incentive"))
    pct = F.col("rate") * F.lit(D(FX.PERCENT))
    return c.select(
        F.col("c_custkey").alias("prof_rut"), F.col("c_name").alias("prof_name"),
        F.col("c_mktsegment").alias("profession"), F.col("n_name").alias("health_plan"),
        sal.alias("base_salary"),
        (F.col("commission") * 100).cast("decimal(6,2)").alias("commission_pct"),
        round0(sal * comm).alias("commission_value"),
        round0(sal * pct).alias("fee_value"),
        bonus.cast("int").alias("mobility_bonus"),
        round0(sal + sal * comm + sal * pct + bonus).alias("total_pay"))


PAYROLL_SCHEMA = T.StructType([
    T.StructField("prof_rut", T.LongType()), T.StructField("prof_name", T.StringType()),
    T.StructField("profession", T.StringType()), T.StructField("health_plan", T.StringType()),
    T.StructField("base_salary", T.DecimalType(18, 2)),
    T.StructField("commission_pct", T.DecimalType(6, 2)),
    T.StructField("commission_value", T.DecimalType(38, 0)),
    T.StructField("fee_value", T.DecimalType(38, 0)),
    T.StructField("mobility_bonus", T.IntegerType()),
    T.StructField("total_pay", T.DecimalType(38, 0))])


def reload_payroll(ctx: Ctx) -> DataFrame:
    """R20 as ``TRUNCATE`` + ``INSERT … SELECT`` into the declared payroll
    table, then ``SELECT *``."""
    return ctx.store.reload(payroll(ctx), "payroll", schema=PAYROLL_SCHEMA)


# -- R21 --------------------------------------------------------------------
def product_table(ctx: Ctx) -> DataFrame:
    """The product table with the link column that R21 adds."""
    return ctx.t.part.select("p_partkey", "p_name", "p_brand", F.lit(None).cast("long").alias("related_part"))


def update_literal_ranged(ctx: Ctx, first=(99, 100), second=(101, 999, 1000), ranges: int = 16) -> DataFrame:
    """R21 on a table cut into key ranges: only the ranges that hold keys of the
    two predicates are read and written again, in one commit."""
    t = RangedTable(ctx.store, "product_ranged", "p_partkey")
    t.create(product_table(ctx), ranges)
    key = F.col("p_partkey")
    return t.update_where(({"related_part": F.lit(first[1])}, key <= first[0]),
                          ({"related_part": F.lit(second[2])}, (key >= second[0]) & (key <= second[1])))


def update_literal(ctx: Ctx, first=(99, 100), second=(101, 999, 1000)) -> DataFrame:
    """Two ``UPDATE … SET related = k WHERE <literal predicate>`` on the
    product table (a NULL link column added first), committed together as
    one new version, as the reference commits once after both.

    ``first`` = (max key, link) for ``key <= max``; ``second`` = (lo, hi,
    link) for ``lo <= key AND key <= hi``."""
    store = ctx.store
    store.create_as(product_table(ctx), "product")
    key = F.col("p_partkey")

    def both_updates(t: DataFrame) -> DataFrame:
        # two statements, one transaction: applied in order, one commit
        t = update_where(t, {"related_part": F.lit(first[1])}, key <= first[0])
        return update_where(t, {"related_part": F.lit(second[2])},
                            (key >= second[0]) & (key <= second[1]))

    return store.replace_with(both_updates, "product")
