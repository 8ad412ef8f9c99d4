"""SQL text builders for the independent DuckDB oracle (``oracle_sql()``).

These produce plain SQL snippets with the same semantics as the Column
helpers in ``quill.functions``; they exist only so each checked report has
a hand-written SQL twin. They are not used by any Spark job.
"""

from __future__ import annotations

import datetime as dt

from quill.functions.text import MONTHS_ES


def d(x: str) -> str:
    """Money as DECIMAL(18,2)."""
    return f"CAST({x} AS DECIMAL(18,2))"


def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def round0(x: str) -> str:
    return f"CAST(round({x}, 0) AS DECIMAL(38,0))"


def round_ratio(num: str, den: str) -> str:
    n, q = f"CAST({num} AS BIGINT)", f"CAST(nullif({den}, 0) AS BIGINT)"
    core = f"((2 * abs({n}) + {q}) // (2 * {q}))"
    return f"(CASE WHEN {n} < 0 THEN -{core} ELSE {core} END)"


def mean_rounded(sum_units: str, count: str, units: int = 100) -> str:
    return round_ratio(sum_units, f"CAST({count} AS BIGINT) * {units}")


def group_thousands(n: str) -> str:
    return f"replace(format('{{:,}}', CAST({n} AS BIGINT)), ',', '.')"


def grouped(x: str) -> str:
    r = round0(x)
    return f"((CASE WHEN {r} < 0 THEN '-' ELSE '' END) || {group_thousands(f'abs({r})')})"


def money(x: str, symbol: str = "$", in_mask: bool = False) -> str:
    r = round0(x)
    sign = f"(CASE WHEN {r} < 0 THEN '-' ELSE '' END)"
    body = group_thousands(f"abs({r})")
    if in_mask:
        return f"({sign} || '{symbol}' || {body})"
    return f"('{symbol}' || {sign} || {body})"


def fixed2(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,4)), 2) AS DECIMAL(38,2)) AS VARCHAR)"


def national_id(num: str, check: str) -> str:
    return f"({group_thousands(num)} || '-' || CAST({check} AS VARCHAR))"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
            r"'([\p{L}\p{N}]+|[^\p{L}\p{N}]+)', 1), "
            "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")


def concat0(*parts: str) -> str:
    """NULL-as-empty concatenation; empty result → NULL."""
    return "nullif(concat(" + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), '')"


def full_name(*parts: str) -> str:
    seq = []
    for i, p in enumerate(parts):
        if i:
            seq.append("' '")
        seq.append(p)
    return concat0(*seq)


def has_word_starting(x: str, prefix: str) -> str:
    return f"regexp_matches(lower({x}), '(^|[^\\p{{L}}\\p{{N}}])' || '{prefix.lower()}')"


def mask_id(x: str) -> str:
    pos = f"instr({x}, '-')"
    return (f"(CASE WHEN {pos} = 0 THEN {x} ELSE "
            f"lpad(substr({x}, 1, {pos} - 1), 10, '*') || substr({x}, {pos}) END)")


def mail_domain(x: str) -> str:
    return f"upper(substr({x}, instr({x}, '@') + 1))"


def day_de_month(x: str) -> str:
    names = ", ".join(f"'{m}'" for m in MONTHS_ES)
    return (f"(lpad(CAST(day({x}) AS VARCHAR), 2, '0') || ' de ' || "
            f"[{names}][month({x})])")


def in_year(x: str, year: int) -> str:
    return f"({x} >= TIMESTAMP '{year}-01-01 00:00:00' AND {x} < TIMESTAMP '{year + 1}-01-01 00:00:00')"


def in_month(x: str, year: int, month: int) -> str:
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    return (f"({x} >= TIMESTAMP '{year}-{month:02d}-01 00:00:00' AND "
            f"{x} < TIMESTAMP '{ny}-{nm:02d}-01 00:00:00')")


def years_between(as_of: dt.date, x: str) -> str:
    """TRUNC(MONTHS_BETWEEN(as_of, x)/12) for x <= as_of via whole months."""
    return f"CAST(floor(datesub('month', CAST({x} AS DATE), DATE '{as_of:%Y-%m-%d}') / 12) AS INTEGER)"


def simple_case(x: str, mapping: dict, default) -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {arms} ELSE {q(default)} END)"
