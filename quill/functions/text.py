"""Text expressions with the reference dialect's semantics, as native Columns.

No Python UDF: each helper composes built-in functions so it stays inside the
JVM (and, where the function supports it, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col

# Spanish month names used by the 'Month' date mask.
MONTHS_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
             "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]

# A word is a maximal run of letters/digits; everything else separates words.
WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def concat0(*parts) -> Column:
    """``a || b || ...`` where NULL acts as the empty string, and an empty
    result is NULL (the dialect does not distinguish '' from NULL)."""
    cols = [as_col(p).cast("string") for p in parts]
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def lit_concat(*parts) -> Column:
    """Like :func:`concat0` but plain ``str`` parts are literals, not names."""
    cols = [F.lit(p) if isinstance(p, str) else as_col(p).cast("string") for p in parts]
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def full_name(*parts, sep: str = " ") -> Column:
    """``a || ' ' || b || ' ' || c`` with the NULL-as-empty rule."""
    seq = []
    for i, p in enumerate(parts):
        if i:
            seq.append(sep)
        seq.append(as_col(p))
    return lit_concat(*seq)


def title_case(c) -> Column:
    """INITCAP: lower-case everything, upper-case the first character of each
    run of letters/digits; any other character starts a new word."""
    pieces = F.regexp_extract_all(F.lower(as_col(c)), F.lit(WORD_OR_GAP), 1)
    caps = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                  F.substring(w, 2, 1 << 30)))
    return F.array_join(caps, "")


def has_word_starting(c, prefix: str) -> Column:
    """``INITCAP(c) LIKE '%Prefix%'``: some word of ``c`` starts with ``prefix``
    (case-insensitive). Written as a regex on the lower-cased text."""
    return F.lower(as_col(c)).rlike(r"(^|[^\p{L}\p{N}])" + _re_escape(prefix.lower()))


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in s)


def group_thousands(n) -> Column:
    """Integral number with '.' between groups of three digits."""
    return F.translate(F.format_number(as_col(n).cast("decimal(38,0)"), 0), ",", ".")


def national_id(number, check) -> Column:
    """National id ``dd.ddd.ddd-v``: right-anchored digit groups, then the
    check character. Valid for any digit count (7-, 8- and 9-digit ids)."""
    return F.concat(group_thousands(number), F.lit("-"), as_col(check).cast("string"))


def mask_id(c) -> Column:
    """Left part of ``id-v`` padded (or cut) to 10 with ``*``, then ``-v``.
    Without a ``-`` the whole text is returned (the dialect's NULL rules)."""
    c = as_col(c)
    pos = F.instr(c, "-")
    left = F.lpad(F.substr(c, F.lit(1), pos - 1), 10, "*")
    return F.when(pos == 0, c).otherwise(F.concat(left, F.substr(c, pos)))


def mail_domain(c) -> Column:
    """Upper-cased text after the first ``@``; the whole text when absent."""
    c = as_col(c)
    return F.upper(F.substr(c, F.instr(c, "@") + 1))


def month_name_es(d) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), F.month(as_col(d)))


def day_de_month(d) -> Column:
    """Date mask ``DD "de" Month`` in Spanish (padding of the month name trimmed)."""
    d = as_col(d)
    return F.concat(F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit(" de "),
                    month_name_es(d))
