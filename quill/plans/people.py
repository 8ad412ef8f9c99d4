"""How the reports' people and companies map onto the star schema.

The reference's workers, clients, professionals and companies all become
``customer`` rows: the customer key is the id number, its last digit the
check character, the account balance the salary/income/credit figure, the
market segment the category, the nation the city/district and the region
the branch. Orders play tickets, fees and advisories; line items play
commissions and loans. Dates derived per customer (first order = hire or
start date) come from one aggregate over ``orders``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.functions import dec, national_id
from quill.functions.dates import ts_lit


def check_char(key="c_custkey") -> Column:
    return F.pmod(F.col(key), F.lit(10)).cast("string")


def person_id(key="c_custkey") -> Column:
    """``dd.ddd.ddd-v`` id text of a customer."""
    return national_id(F.col(key), check_char(key))


def salary(col="c_acctbal") -> Column:
    return dec(col)


def order_profile(orders: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """Per customer: first and last order day and order count, plus any
    ``extra`` aggregates — one partial+final aggregation over ``orders``."""
    aggs = [F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
            F.count(F.lit(1)).alias("order_count")] + list(extra or [])
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*aggs)


def open_at(as_of: dt.date, valid_days: int = 730) -> Column:
    """Orders as status history: a row is valid from its order day for
    ``valid_days``, or open-ended while the order is open (``O``); true when
    still valid at ``as_of`` (``end IS NULL OR end > as_of``).

    ``day + valid_days > as_of`` is written as a bound on the stored column, so
    that it reaches the scan; a missing order day leaves the end open."""
    first = dt.datetime.combine(as_of - dt.timedelta(days=valid_days - 1), dt.time())
    return ((F.col("o_orderstatus") == "O") | F.col("o_orderdate").isNull()
            | (F.col("o_orderdate") >= ts_lit(first)))
