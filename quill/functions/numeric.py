"""Exact-number helpers (Oracle NUMBER semantics on Spark decimals and longs)."""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col

MONEY = "decimal(18,2)"


def dec(c, precision: int = 18, scale: int = 2) -> Column:
    """Cast to an exact decimal; money arrives as DOUBLE in the test tables."""
    return as_col(c).cast(f"decimal({precision},{scale})")


def round0(c) -> Column:
    """ROUND(x) on an exact number: half away from zero, integral decimal."""
    return F.round(as_col(c), 0).cast("decimal(38,0)")


def trunc0(c) -> Column:
    """TRUNC(x): toward zero (``floor`` is wrong for negatives)."""
    c = as_col(c)
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c))


def int_div(a, b) -> Column:
    """Exact integer division of longs (Spark's ``div``)."""
    return F.call_function("div", as_col(a), as_col(b))


def round_ratio(num, den) -> Column:
    """ROUND(num / den) for integral ``num`` and ``den > 0``, half away from zero.

    Pure integer arithmetic, so no intermediate decimal or double rounding can
    move a result across the .5 boundary; NULL when ``den`` is 0 or NULL.
    """
    num = as_col(num).cast("long")
    den = F.nullif(as_col(den).cast("long"), F.lit(0))
    q = int_div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def mean_rounded(sum_units, count, units_per_one: int = 100) -> Column:
    """ROUND(AVG(x)) from SUM(x) in integral units (cents by default) and COUNT(x)."""
    return round_ratio(sum_units, as_col(count).cast("long") * units_per_one)


def units(c, scale: int = 2) -> Column:
    """A number as a long count of 10^-scale, rounded half away from zero.

    Sums of longs stay in the compact, code-generated path; sums of wide
    decimals (precision > 18) fall back to BigDecimal and measured ~2x
    slower. For DOUBLE input this is double arithmetic (no per-row
    BigDecimal, which a cast to DECIMAL costs) and equals the value's
    cents whenever it carries at most ``scale`` decimals, as money does;
    on half-cent doubles it rounds the binary value, as DuckDB's
    ``CAST(x AS DECIMAL)`` does. DECIMAL input stays exact (0.5 is a
    decimal literal)."""
    x = as_col(c)
    m = F.floor(F.abs(x) * (10 ** scale) + F.lit(decimal.Decimal("0.5")))
    return F.when(x < 0, -m).otherwise(m).cast("long")


def cents(c) -> Column:
    """Money as a long count of hundredths (exact for DECIMAL(p,2))."""
    return units(c, 2)


def from_units(u, scale: int = 2) -> Column:
    """Back from a long count of 10^-scale to an exact DECIMAL(38, scale)."""
    return as_col(u).cast("decimal(38,0)") * F.lit(decimal.Decimal(1).scaleb(-scale))
