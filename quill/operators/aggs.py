"""Aggregate expressions: conditional counts/sums, KEEP (DENSE_RANK LAST).

All are ordinary aggregate Columns, so Spark computes them with a partial
(map-side) aggregate before the shuffle: a key holding a third of the rows
still sends one row per map task.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col


def cond_count(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)``."""
    return F.count_if(pred)


def cond_sum(pred: Column, x) -> Column:
    """``SUM(CASE WHEN pred THEN x ELSE 0 END)``."""
    return F.sum(F.when(pred, as_col(x)).otherwise(F.lit(0)))


def keep_last(value, order) -> Column:
    """``MAX(value) KEEP (DENSE_RANK LAST ORDER BY order)``.

    Among rows with the greatest ``order`` the greatest ``value``. In the
    reference dialect NULLs sort last in ascending order, so rows with a NULL
    ``order`` *are* the last rank whenever they exist: the leading
    ``isNull`` field reproduces that. ``max_by`` would leave ties unspecified.
    Works for any types, but a struct as aggregation buffer makes Spark sort;
    see :func:`keep_last_key` for numbers.
    """
    order, value = as_col(order), as_col(value)
    best = F.max(F.struct(order.isNull().alias("n"), order.alias("o"), value.alias("v")))
    return best.getField("v")


_LOW = decimal.Decimal(2) ** 63 + 1    # takes every long above 0, which is left for NULL
_KEYS = 2 * decimal.Decimal(10) ** 19   # above every long so moved


def keep_last_key(key, amount) -> Column:
    """:func:`keep_last` for a key (any long, or NULL) by an integral amount of at
    most 18 digits: amount (NULL above all) and key (NULL below all) packed into
    one DECIMAL(38,0), so that both phases are hash aggregates without a sort."""
    bound = decimal.Decimal(10) ** 18
    rank = F.coalesce(as_col(amount).cast("decimal(18,0)") + F.lit(bound), F.lit(3 * bound)).cast("decimal(19,0)")
    place = F.coalesce(as_col(key).cast("decimal(20,0)") + F.lit(_LOW), F.lit(decimal.Decimal(0))).cast("decimal(20,0)")
    packed = ((rank * F.lit(_KEYS)).cast("decimal(38,0)") + place).cast("decimal(38,0)")
    best = (F.max(packed) % F.lit(_KEYS)).cast("decimal(20,0)")
    return F.when(best > 0, best - F.lit(_LOW)).cast("long")
