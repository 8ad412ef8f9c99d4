"""One query per building-block operator, each over the whole input tables:
scan/projection, lenient load, generated keys, band joins, EXISTS, INTERSECT,
latest row, rule audits and the lookup-oriented layout."""

from __future__ import annotations

import decimal
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions import dec, in_month, in_year, to_day, years_between
from quill.functions.dates import add_months_year
from quill.operators import (assign_keys, band_join, check_rules, dependences, duplicate_keys,
                             intersect_distinct, latest_per_key, null_counts, orphan_keys, orphans, write_rules)
from quill.operators.audit import union_all
from quill.plans.context import Ctx
from quill.plans.people import open_at
from quill.sources.delimited import Field, load_delimited
from quill.sources.params import literal_bands
from quill.sources.layout import bucketed_by, catalog_name, clustered_by, partitioned_by
from quill.sources.lenient import lenient_date, lenient_number
from quill.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS

D = decimal.Decimal
AUDITED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def scan_project(ctx: Ctx) -> DataFrame:
    """A1/B1: scan with a column subset and aliases (only these columns are read)."""
    return ctx.t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"), dec("l_quantity").alias("quantity"),
        dec("l_extendedprice").alias("amount"), to_day("l_shipdate").alias("ship_day"))


def lenient_cast_load(ctx: Ctx) -> DataFrame:
    """A3/A4: order dates and amounts rendered as text the way the reference's
    literal rows arrive (three date shapes, a junk amount every 7th order),
    then loaded back with lenient conversions; plus a date re-anchored to the
    year before the run date."""
    o = ctx.t.orders
    shape = F.pmod(F.col("o_orderkey"), F.lit(3))
    d = F.col("o_orderdate")
    date_text = (F.when(shape == 0, F.date_format(d, "ddMMyyyy"))
                 .when(shape == 1, F.date_format(d, "dd/MM/yyyy"))
                 .otherwise(F.date_format(d, "dd-MM-yyyy")))
    amount_text = F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, F.lit("n/a")).otherwise(
        dec("o_totalprice").cast("string"))
    t = o.select("o_orderkey", date_text.alias("date_text"), amount_text.alias("amount_text"))
    parsed = lenient_date("date_text")
    return t.select("o_orderkey", "date_text", parsed.alias("parsed_date"), "amount_text",
                    lenient_number("amount_text").alias("amount"),
                    F.make_date(F.lit(ctx.as_of.year - 1), F.month(parsed), F.lit(1))
                    .alias("rerun_date"))


#: fields of the text file that ``csv_load`` reads
ORDER_FIELDS = [Field("o_orderkey", T.LongType(), required=True), Field("o_custkey", T.LongType(), required=True),
                Field("o_orderstatus", T.StringType()), Field("o_totalprice", T.DecimalType(18, 2)),
                Field("o_orderdate", T.DateType(), required=True)]


def order_lines(ctx: Ctx) -> DataFrame:
    """The orders as lines of a text file as they come in: three date shapes, every
    7th amount unreadable, every 11th line short, every 13th with a field too
    many, every 17th without a customer."""
    o, k = ctx.t.orders, F.col("o_orderkey")

    def every(n: int):
        return F.pmod(k, F.lit(n)) == 0
    d = F.col("o_orderdate")
    date = (F.when(F.pmod(k, F.lit(3)) == 0, F.date_format(d, "ddMMyyyy"))
            .when(F.pmod(k, F.lit(3)) == 1, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "dd-MM-yyyy")))
    amount = F.when(every(7), F.lit("n/a")).otherwise(dec("o_totalprice").cast("string"))
    customer = F.when(every(17), F.lit("")).otherwise(F.col("o_custkey").cast("string"))
    head = F.concat_ws(";", k.cast("string"), customer, "o_orderstatus", amount)
    return o.select(F.when(every(11), head).when(every(13), F.concat_ws(";", head, date, F.lit("extra")))
                    .otherwise(F.concat_ws(";", head, date)).alias("value"))


def csv_load(ctx: Ctx) -> DataFrame:
    """A3: a text file of messy order lines is written, then loaded in one pass into
    a typed table and a quarantine; here both, one row per line."""
    folder = f"{ctx.store.root}/orders_text-{uuid.uuid4().hex}"
    order_lines(ctx).write.text(f"{folder}/lines")
    good, bad = load_delimited(ctx.spark, f"{folder}/lines", ORDER_FIELDS, f"{folder}/loaded")
    nothing = F.lit(None)
    return (good.select("*", nothing.cast("string").alias("line"), F.lit("").alias("reasons"))
            .unionByName(bad.select(*[nothing.cast(f.type).alias(f.name) for f in ORDER_FIELDS],
                                    F.col("_line").alias("line"), F.array_join("_reasons", ", ").alias("reasons"))))


def assign_order_keys(ctx: Ctx, start: int = 80) -> DataFrame:
    """Dense surrogate keys from ``start`` in order-key order."""
    return assign_keys(ctx.t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"],
                       key="key", start=start)


# Value bands for the stored-value range join: overlap at 0 and 5000 (both
# ends inclusive), gap between 8000 and 9000.
VALUE_BANDS = [("-1000", "0", "1"), ("0", "5000", "2"), ("5000", "8000", "3"),
               ("9000", "10000", "4")]
# Whole-year bands: overlap at 3, nothing for 6 years.
YEAR_BANDS = [(0, 1, "0.01"), (2, 3, "0.03"), (3, 5, "0.05")]


def band_join_value(ctx: Ctx, **options) -> DataFrame:
    """Balance BETWEEN band.lo AND band.hi."""
    bands, st = literal_bands(ctx.spark, VALUE_BANDS, edge_type=T.DecimalType(18, 2))
    c = ctx.t.customer.select("c_custkey", dec("c_acctbal").alias("balance"))
    return band_join(c, F.col("balance"), bands, stats=st, **options).select(
        "c_custkey", "balance", "lo", "hi", F.col("rate").alias("band"))


def band_join_shuffled(ctx: Ctx) -> DataFrame:
    """C6 as for a band table too large to broadcast: both sides are shuffled on
    the bucket."""
    return band_join_value(ctx, broadcast_rows=0)


def band_join_tenure(ctx: Ctx) -> DataFrame:
    """Whole years since the order date BETWEEN band.lo AND band.hi."""
    o = ctx.t.orders.select("o_orderkey", years_between(ctx.as_of, "o_orderdate").alias("tenure"))
    bands, st = literal_bands(ctx.spark, YEAR_BANDS)
    return band_join(o, F.col("tenure"), bands, stats=st).select(
        "o_orderkey", "tenure", "lo", "hi", "rate")


def semi_exists(ctx: Ctx, month: int = 3) -> DataFrame:
    """Customers WHERE EXISTS (an order in ``month`` of last year) —
    a left semi join: each customer at most once, no order columns."""
    year = add_months_year(ctx.as_of, -12)
    o = ctx.t.orders.filter(in_month("o_orderdate", year, month))
    c = ctx.t.customer
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


def intersect_keys(ctx: Ctx, a: str = "F", b: str = "O") -> DataFrame:
    """G1: customers with status-``a`` orders INTERSECT those with status ``b``."""
    o = ctx.t.orders
    return intersect_distinct(o.filter(F.col("o_orderstatus") == a).select("o_custkey"),
                              o.filter(F.col("o_orderstatus") == b).select("o_custkey"))


def latest_status(ctx: Ctx, valid_days: int = 730, method: str = "aggregate") -> DataFrame:
    """Per customer, the latest status row still open at the run date
    (orders as status history, see R3), tie-broken by order key."""
    o = (ctx.t.orders.filter(open_at(ctx.as_of, valid_days))
         .select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"))
    return latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], method=method)


def audit_pk(ctx: Ctx) -> DataFrame:
    """Duplicate or NULL primary keys of every table."""
    return union_all([duplicate_keys(ctx.t.get(t), t, list(PRIMARY_KEYS[t])) for t in AUDITED])


def audit_fk(ctx: Ctx) -> DataFrame:
    """Per reference, rows checked and rows without a parent row."""
    return union_all([orphans(ctx.t.get(ct), ct, cc, ctx.t.get(pt), pc)
                      for ct, cc, pt, pc in FOREIGN_KEYS])


#: references that the declared ones do not cover: they do have orphans
LOOSE_KEYS = [("events", "value", "orders", "o_orderkey"), ("part", "p_size", "nation", "n_nationkey")]


def audit_fk_keys(ctx: Ctx) -> DataFrame:
    """The references without a parent row, each with its number of rows, of
    the declared foreign keys and of two that do not hold."""
    whole = F.floor("value").cast("long").alias("value")
    child = {"events": ctx.t.events.select("user_id", whole)}
    return union_all([orphan_keys(child.get(ct, ctx.t.get(ct)), ct, cc, ctx.t.get(pt), pc)
                      for ct, cc, pt, pc in [*FOREIGN_KEYS, *LOOSE_KEYS]])


def audit_dependence(ctx: Ctx) -> DataFrame:
    """Columns carried along a grouping key that do not follow from it, for the
    keys that the reports group by; the report lists the broken pairs."""
    li = ctx.t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    found = [dependences(ctx.t.customer, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"]),
             dependences(ctx.t.part, "part", ["p_partkey", "p_name", "p_type"]),
             dependences(ctx.t.orders, "orders", ["o_custkey"]),
             dependences(li, "lineitem", ["l_orderkey", "l_returnflag"])]
    return union_all(found).filter("n > 0")


def audit_on_write(ctx: Ctx) -> DataFrame:
    """A15 within A5: the tables are written, and the job that writes counts the
    rows that break each NOT NULL and CHECK rule; no second scan."""
    found = []
    for t, rules in domain_rules().items():
        df = ctx.t.get(t)
        ctx.store.create_as(df, f"audited_{t}", enforce=False, rules=write_rules(df.schema, df.columns, rules))
        for rule, n in ctx.store.audited.items():
            found.append((t, *rule.split(":"), n))
    return ctx.spark.createDataFrame(found, "table_name string, rule string, column_name string, n long")


def audit_not_null(ctx: Ctx) -> DataFrame:
    """NULL count of every column of every table (zeros included), and of
    the table loaded from text, where unreadable amounts became NULL."""
    loaded = null_counts(lenient_cast_load(ctx), "loaded_orders", ["parsed_date", "amount"], keep_zero=True)
    return union_all([null_counts(ctx.t.get(t), t, SCHEMAS[t].fieldNames(), keep_zero=True)
                      for t in AUDITED] + [loaded])


def domain_rules():
    """CHECK / domain / length rules per table: (rule, column, ok predicate)."""
    c = F.col
    return {
        "customer": [("segment_domain", "c_mktsegment",
                      c("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD",
                                             "MACHINERY")),
                     ("balance_non_negative", "c_acctbal", c("c_acctbal") >= 0),
                     ("name_length_25", "c_name", F.length("c_name") <= 25)],
        "orders": [("status_domain", "o_orderstatus", c("o_orderstatus").isin("F", "O", "P")),
                   ("price_precision_8_2", "o_totalprice", F.abs("o_totalprice") < 1_000_000)],
        "lineitem": [("returnflag_domain", "l_returnflag", c("l_returnflag").isin("A", "N", "R")),
                     ("linestatus_domain", "l_linestatus", c("l_linestatus").isin("O", "F")),
                     ("discount_range", "l_discount", c("l_discount").between(0, 0.1)),
                     ("quantity_positive", "l_quantity", c("l_quantity") > 0)],
        "part": [("size_range", "p_size", c("p_size").between(1, 50))],
    }


def audit_check(ctx: Ctx) -> DataFrame:
    """Rows violating a CHECK / domain / length rule."""
    return union_all([check_rules(ctx.t.get(t), t, list(PRIMARY_KEYS[t]), rules)
                      for t, rules in domain_rules().items()])


def layout_year_pruned(ctx: Ctx, years_back: int = 1) -> DataFrame:
    """Orders rewritten partitioned by order year and sorted by date
    within files (the re-aim of the reference's date index), then a read of
    one year that lists only that year's folder."""
    t = partitioned_by(ctx.store, ctx.t.orders, "orders_by_year", "o_year",
                       F.year("o_orderdate"), ["o_orderdate"])
    return (t.filter(F.col("o_year") == ctx.as_of.year - years_back)
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_year"))


def calendar_table(ctx: Ctx) -> DataFrame:
    """The years that occur in the data, with their distance to the run date."""
    years = ctx.t.orders.groupBy(F.year("o_orderdate").alias("c_year")).agg(F.count(F.lit(1)).alias("orders"))
    return years.select("c_year", "orders", (F.lit(ctx.as_of.year) - F.col("c_year")).alias("years_ago"))


def calendar_pruned(ctx: Ctx, low: int = 1, high: int = 2) -> DataFrame:
    """Orders of the years that a calendar table picks by the run date. The
    filter is on the calendar; Spark prunes the year folders of the orders with
    what it finds there (dynamic partition pruning)."""
    fact = partitioned_by(ctx.store, ctx.t.orders, "orders_by_year_c", "o_year", F.year("o_orderdate"), ["o_orderdate"])
    cal = ctx.store.create_as(calendar_table(ctx), "calendar")
    picked = cal.filter(F.col("years_ago").between(low, high))
    return (fact.join(picked, F.col("o_year") == F.col("c_year"))
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_year", "years_ago"))


def append_sparse_keys(ctx: Ctx) -> DataFrame:
    """A11, the sparse form: two inserts draw keys in blocks. Which row gets which
    key is open; the report shows what holds of the keys of each status."""
    o = ctx.t.orders.select("o_orderkey", "o_orderstatus")
    ctx.store.create_empty("sparse", T.StructType([T.StructField("num", T.LongType()), *o.schema.fields]))
    ctx.store.append_sparse(o.filter(F.col("o_orderstatus") == "F"), "sparse", "num", start=80, step=10)
    first_top = ctx.store.high_water("sparse", "num")
    t = ctx.store.append_sparse(o.filter(F.col("o_orderstatus") != "F"), "sparse", "num", start=80, step=10)
    per = t.groupBy("num").agg(F.count(F.lit(1)).alias("uses"), F.min("o_orderkey").alias("o_orderkey"))
    status = ctx.t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return per.join(status, "o_orderkey").groupBy("status").agg(
        F.sum("uses").alias("rows"), F.count(F.lit(1)).alias("keys"), F.min(F.col("num") >= 80).alias("from_start"),
        F.min(F.pmod(F.col("num") - 80, F.lit(10)) == 0).alias("on_step"),
        F.min(F.when(F.col("status") != "F", F.col("num") > first_top)).alias("above_first"))


def layout_join_key(ctx: Ctx, buckets: int = 16) -> DataFrame:
    """Orders saved bucketed on the customer key, then joined per customer:
    the order side is read in buckets, without an exchange."""
    o = ctx.t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    saved = bucketed_by(o, catalog_name(ctx.spark, "quill_orders_by_customer"), f"{ctx.store.root}/orders_by_customer",
                        "o_custkey", buckets)
    per = saved.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum(dec("o_totalprice")).alias("total"))
    return (ctx.t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", "orders", "total"))


def layout_two_columns(ctx: Ctx, part: int = 77) -> DataFrame:
    """Line items clustered on (part, ship date), then the loans of one part
    in one year: both bounds reach the scan of the sorted files."""
    t = clustered_by(ctx.store, ctx.t.lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber"),
                     "lines_by_part_date", ["l_partkey", "l_shipdate"])
    return t.filter((F.col("l_partkey") == part) & in_year("l_shipdate", ctx.as_of.year - 2))
