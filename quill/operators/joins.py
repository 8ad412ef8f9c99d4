"""Joins Spark has no single operator for: range joins onto band tables.

``value BETWEEN band.lo AND band.hi`` planned naively is a nested-loop or
Cartesian join. Here it becomes an equi-join: the value axis is cut into
buckets, every band is exploded into the buckets it covers, rows join on the
bucket id, and the exact inclusive comparison is the residual filter. The
band side is broadcast only when an upper bound on its exploded row count —
computed from the band table, not guessed — is under a limit; otherwise both
sides shuffle on the bucket id (AQE may still switch to broadcast at run
time, and splits a hot bucket). For bands as many as the data see
``intervals.interval_join``: no bucket width fits wide and narrow bands alike.

Semantics kept from the reference: both ends inclusive, a value in no band
drops the row (inner join), a value in two overlapping bands yields two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.functions._col import as_col
from quill.operators.intervals import interval_audit

BROADCAST_ROWS = 200_000
TARGET_BUCKETS = 4096


def band_stats(rows) -> dict:
    """Statistics of a literal band list ``[(lo, hi, ...), ...]`` (no job)."""
    los, his = [float(r[0]) for r in rows], [float(r[1]) for r in rows]
    return {"mn": min(los, default=None), "mx": max(his, default=None), "n": len(rows),
            "len": sum(max(h - lo, 0.0) for lo, h in zip(los, his))}


def band_join(df: DataFrame, value, bands: DataFrame, lo: str = "lo", hi: str = "hi", *,
              how: str = "inner", broadcast_rows: int = BROADCAST_ROWS,
              target_buckets: int = TARGET_BUCKETS, stats: dict | None = None) -> DataFrame:
    """Join each row of ``df`` to every band of ``bands`` with ``lo <= value <= hi``.

    ``how`` is ``inner`` (reference semantics) or ``left`` (keep unbanded rows
    with NULL band columns). Band columns other than ``lo``/``hi`` are kept.
    ``stats`` (see :func:`band_stats`) skips the statistics job when the
    band table was built from literal rows.
    """
    value = as_col(value)
    # Axis range, band count and total band length fix the bucket width and
    # bound the exploded size: one small job over the band table, unless given.
    st = stats or bands.agg(
        F.min(lo).cast("double").alias("mn"), F.max(hi).cast("double").alias("mx"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.greatest(F.col(hi).cast("double") - F.col(lo).cast("double"), F.lit(0.0))).alias("len")).first()
    n = st["n"] or 0
    mn, mx = (st["mn"], st["mx"]) if n and st["mn"] is not None else (0.0, 0.0)
    width = max((mx - mn) / target_buckets, 1.0) if mx > mn else 1.0

    def bucket(c: Column) -> Column:
        # floor((c - mn) / width) is monotone in c, so a value inside [lo, hi]
        # always lands in a bucket between bucket(lo) and bucket(hi).
        return F.floor((c.cast("double") - F.lit(mn)) / F.lit(width)).cast("long")

    # a band with lo > hi holds no value
    exploded = bands.filter(F.col(lo) <= F.col(hi)).withColumn(
        "_band_bucket", F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi)))))
    # a band [lo, hi] covers at most (hi - lo) / width + 2 buckets
    max_rows = (st["len"] or 0.0) / width + 2 * n
    if max_rows <= broadcast_rows:
        exploded = F.broadcast(exploded)
    left = df.withColumn("_band_bucket", bucket(value))
    cond = ((left["_band_bucket"] == exploded["_band_bucket"])
            & (value >= exploded[lo]) & (value <= exploded[hi]))
    out = left.join(exploded, cond, how)
    return out.drop(left["_band_bucket"]).drop(exploded["_band_bucket"])


def band_audit(bands: DataFrame, lo: str = "lo", hi: str = "hi", step=0) -> DataFrame:
    """Gaps and overlaps of one band table: :func:`interval_audit` without a key.

    ``step`` is the grid of an integral axis (1 for years): a gap exists when a
    band starts more than ``step`` after every band before it has ended."""
    return interval_audit(bands, lo, hi, step=step)


def filtered_left_join(left: DataFrame, right: DataFrame, on, right_filter: Column | None = None
                       ) -> DataFrame:
    """``LEFT JOIN right ON key AND <right-side predicates>``.

    The predicate restricts the right side *before* the join, so a left row
    whose matches are all filtered out survives with NULLs (putting it in
    WHERE would turn the outer join into an inner one)."""
    if right_filter is not None:
        right = right.filter(right_filter)
    return left.join(right, on, "left")
