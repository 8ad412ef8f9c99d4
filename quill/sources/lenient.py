"""Loading text with the reference dialect's implicit conversions.

The reference inserts dates as text in several shapes ('ddMMyyyy',
'dd/MM/yyyy', 'dd-MM-yyyy') that one session format accepted leniently, and
numbers as text. A strict pattern would fail on the other shapes, so the
separators are stripped first; bad values become NULL (``try_``) instead of
failing the job, so an audit can count them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col


def lenient_date(c) -> Column:
    """Day-month-year text with any (or no) separators → DATE, else NULL."""
    digits = F.regexp_replace(as_col(c), r"[^0-9]", "")
    return F.to_date(F.try_to_timestamp(F.when(F.length(digits) == 8, digits),
                                        F.lit("ddMMyyyy")))


def lenient_number(c, precision: int = 18, scale: int = 2) -> Column:
    """Numeric text → DECIMAL(p,s), NULL when it does not parse."""
    return F.trim(as_col(c)).try_cast(f"decimal({precision},{scale})")
