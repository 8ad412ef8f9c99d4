"""``CASE code WHEN k1 THEN v1 ... ELSE d END`` (simple CASE) as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col


def simple_case(c, mapping: dict, default) -> Column:
    """Code → label. Short literal maps stay an expression (codegen'd); a long
    map belongs in a small lookup table joined with ``broadcast``."""
    c = as_col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)
