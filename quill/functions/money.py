"""Number-to-text masks (``TO_CHAR(n, '...G...')``) without ``to_char``.

Spark's ``to_char`` rejects FM/L masks, renders 0 as blanks and drops the
minus sign for these masks, so every mask here is built from ``round`` +
``format_number`` + ``translate``. Group separator is '.', as in all uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col
from quill.functions.numeric import round0
from quill.functions.text import group_thousands


def grouped(x) -> Column:
    """``TO_CHAR(ROUND(x), 'FM9G999G990')``: rounded, '.'-grouped, sign kept."""
    r = round0(as_col(x))
    return F.concat(F.when(r < 0, F.lit("-")).otherwise(F.lit("")), group_thousands(F.abs(r)))


def money(x, symbol: str = "$", symbol_in_mask: bool = False) -> Column:
    """Money text.

    ``symbol_in_mask=False`` is ``'$' || TO_CHAR(x, 'FM9G999')`` → ``$-1.234``;
    ``True`` is ``TO_CHAR(x, 'FM$9G999')`` (or ``L`` masks) → ``-$1.234``.
    NULL stays NULL. Masks are never too narrow: no value is hashed out.
    """
    r = round0(as_col(x))
    sign = F.when(r < 0, F.lit("-")).otherwise(F.lit(""))
    body = group_thousands(F.abs(r))
    if symbol_in_mask:
        return F.concat(sign, F.lit(symbol), body)
    return F.concat(F.lit(symbol), sign, body)


def fixed2(x) -> Column:
    """``TO_CHAR(x, 'FM99990.00')``: two decimals, no grouping."""
    return F.round(as_col(x).cast("decimal(38,4)"), 2).cast("decimal(38,2)").cast("string")
