"""Range joins and audits whose intervals come from the data: validity periods
of a customer's status, price spans of the catalogue, delivery windows."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.functions import dec, to_day
from quill.operators import interval_audit, interval_join
from quill.plans.context import Ctx


def status_periods(ctx: Ctx) -> DataFrame:
    """Versioned rows: each order opens a status period of its customer that lasts
    until the day before the next order; the last one is open-ended. Of several
    orders on one day the last holds, the others have no day."""
    o = ctx.t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", to_day("o_orderdate").alias("valid_from"))
    nxt = F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from", "o_orderkey"))
    return o.withColumn("valid_to", F.date_sub(nxt, 1))


def interval_join_status(ctx: Ctx, bits: int = 2) -> DataFrame:
    """C6/C7 with a data-sized band side: for every line item, the status its
    customer had on the shipping day."""
    o = ctx.t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = (ctx.t.lineitem.select("l_orderkey", "l_linenumber", to_day("l_shipdate").alias("ship_day"))
             .join(o.hint("merge"), "l_orderkey"))      # orders grow with their lines
    periods = status_periods(ctx).select("o_custkey", "valid_from", "valid_to",
                                         F.col("o_orderkey").alias("status_order"),
                                         F.col("o_orderstatus").alias("status"))
    met = interval_join(lines, "ship_day", periods, "valid_from", "valid_to", on=["o_custkey"], bits=bits)
    return met.select("l_orderkey", "l_linenumber", "ship_day", "status_order", "status", "valid_from")


def price_spans(ctx: Ctx) -> DataFrame:
    """Price span of each brand and size: wide, narrow and nested ones."""
    p = ctx.t.part.select("p_brand", "p_size", dec("p_retailprice").alias("price"))
    return p.groupBy("p_brand", "p_size").agg(F.min("price").alias("lo"), F.max("price").alias("hi"))


def interval_join_prices(ctx: Ctx) -> DataFrame:
    """C6 without a key: per customer, the price spans that hold the balance, and
    the narrowest of them."""
    c = ctx.t.customer.select("c_custkey", dec("c_acctbal").alias("balance"))
    met = interval_join(c, "balance", price_spans(ctx).select("lo", "hi"))
    return met.groupBy("c_custkey", "balance").agg(F.count(F.lit(1)).alias("n_spans"),
                                                   F.min(F.col("hi") - F.col("lo")).alias("narrowest"))


def delivery_windows(ctx: Ctx) -> DataFrame:
    """First and last shipping day of each order."""
    days = ctx.t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(to_day("l_shipdate")).alias("first_day"), F.max(to_day("l_shipdate")).alias("last_day"))
    return ctx.t.orders.select("o_orderkey", "o_custkey").join(days, "o_orderkey")


def interval_audit_deliveries(ctx: Ctx) -> DataFrame:
    """Audit of versioned rows, per customer: delivery windows that overlap
    earlier ones, and days between deliveries."""
    return interval_audit(delivery_windows(ctx), "first_day", "last_day", on=["o_custkey"], step=1)


def interval_audit_prices(ctx: Ctx) -> DataFrame:
    """Audit of one band table without a key, to the cent."""
    return interval_audit(price_spans(ctx), step=decimal.Decimal("0.01"))
