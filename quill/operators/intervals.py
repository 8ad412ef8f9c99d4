"""Interval tables of any size: joining values to them, and auditing them.

**Join.** ``value BETWEEN lo AND hi`` against a table of intervals that grows
with the data (validity periods, price spans) becomes an equi-join. The axis
is a tree of radix ``2^bits``; an interval is the disjoint union of at most
``2 (2^bits - 1)`` nodes per level, a value lies under one node per level, and
the two meet in exactly one node if the interval holds the value. An interval
of a million days is no more rows than one of a hundred, so no bucket width
has to be guessed, and each matching pair comes out once.

**Audit.** Gaps and overlaps of intervals per key, by a running maximum of
their ends: range partitions, one summary per partition and key, and the
maximum carried into a partition from the ones before it. It finds overlaps
between intervals that are not neighbours, and a gap only where nothing covers.

A missing end is open: a NULL ``lo`` reaches back, a NULL ``hi`` forward
without limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions._col import as_col
from quill.session import shared_dir

BITS = 1     # a binary tree: fewest interval rows; more bits: fewer value rows
BROADCAST_BYTES = 10 << 20   # node rows are broadcast below this (Spark's own default)
NODE_BYTES = 64              # of a node row, about


def _axis(c: Column, kind: T.DataType, scale: int) -> Column:
    """The place of a value on the axis: a whole number that never falls as the
    value grows (the comparison itself stays exact)."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DecimalType):
        return F.floor(c * F.lit(10 ** scale)).cast("long")
    if isinstance(kind, T.FractionalType):
        return F.floor(c * F.lit(float(10 ** scale))).cast("long")
    return c.cast("long") * F.lit(10 ** scale)


def _shift(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x, by.cast("int"))


def interval_nodes(first: Column, last: Column, levels: int, bits: int = BITS) -> Column:
    """Array of the tree nodes whose union is ``[first, last]`` (whole numbers of
    ``[0, 2^(bits * levels))``); a node is ``2^(bits * (levels - k)) + index``."""
    radix = 1 << bits
    root = F.lit(1 << (bits * levels)).cast("long")

    def run(lo: Column, hi: Column) -> Column:
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    def at(k: Column) -> Column:
        here, above = k * bits, (k + 1) * bits
        lo, hi = -_shift(-first, here), _shift(last + 1, here)                # [lo, hi) on this level
        up_lo, up_hi = -_shift(-first, above), _shift(last + 1, above)        # what the level above takes
        left = run(lo, F.when(up_lo < up_hi, up_lo * radix).otherwise(hi) - 1)
        right = F.when(up_lo < up_hi, run(up_hi * radix, hi - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.concat(left, right), lambda x: x + _shift(root, here))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def value_nodes(place: Column, levels: int, top: int, bits: int = BITS) -> Column:
    """Array of the nodes above ``place``, one per level ``0 .. top``."""
    leaf = place + F.lit(1 << (bits * levels)).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(top)), lambda k: _shift(leaf, k * bits))


def interval_join(df: DataFrame, value, bands: DataFrame, lo: str = "lo", hi: str = "hi", *,
                  on: list[str] | None = None, how: str = "inner", scale: int = 2, bits: int = BITS) -> DataFrame:
    """Rows of ``df`` with every row of ``bands`` that has the same ``on`` columns and
    ``lo <= value <= hi``.

    ``how`` is ``inner`` or ``left`` (rows without an interval stay, band columns
    NULL). A NULL value lies in no interval; an interval with ``lo > hi`` holds
    none. ``scale`` is how many decimals of fractional columns the tree tells
    apart (more only makes it finer: ends are compared exactly). With ``bits``
    the tree gets flatter: a value takes ``1 / bits`` of the rows, an interval up
    to ``2^bits`` times as many.

    The one job that this runs up front takes the axis' range, the longest
    interval, which bounds the levels that values are dealt to, and the number
    of intervals: their node rows are broadcast only if that many fit, since a
    planner sees the intervals before they become nodes. Otherwise both sides
    shuffle, and a key or node that very many rows share is split by AQE's skew
    join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    on, value = list(on or []), as_col(value)
    kinds = {c: bands.schema[c].dataType for c in (lo, hi)}
    a, b = _axis(F.col(lo), kinds[lo], scale), _axis(F.col(hi), kinds[hi], scale)
    st = bands.agg(F.count(F.lit(1)).alias("n"), F.min(F.least(a, b)).alias("mn"), F.max(F.greatest(a, b)).alias("mx"), F.max(b - a).alias("far"),
                   F.bool_or(F.col(lo).isNull() | F.col(hi).isNull()).alias("open")).first()
    mn, mx = (st["mn"], st["mx"]) if st["mn"] is not None else (0, 0)
    # one place beyond either end stands for all values there
    span = mx - mn + 3
    levels = max(-(-(span - 1).bit_length() // bits), 1)
    far = span if st["open"] else (st["far"] or 0) + 1
    top = min((max(far, 1).bit_length() - 1) // bits, levels)

    tagged = df.withColumn("_value", value)
    place = F.greatest(F.least(_axis(F.col("_value"), tagged.schema["_value"].dataType, scale), F.lit(mx + 1)),
                       F.lit(mn - 1)) - F.lit(mn - 1)
    left = tagged.filter("_value is not null").withColumn("_node", F.explode(value_nodes(place, levels, top, bits)))
    start = F.coalesce(a, F.lit(mn - 1)) - F.lit(mn - 1)
    end = F.coalesce(b, F.lit(mx + 1)) - F.lit(mn - 1)
    right = (bands.filter(F.coalesce(F.col(lo) <= F.col(hi), F.lit(True)))
             .withColumn("_node", F.explode(interval_nodes(start, end, levels, bits))))
    held = ((F.col(lo).isNull() | (F.col("_value") >= F.col(lo))) & (F.col(hi).isNull() | (F.col("_value") <= F.col(hi))))
    most = st["n"] * min(2 * ((1 << bits) - 1) * levels + 1, far) * NODE_BYTES
    right = F.broadcast(right) if most <= BROADCAST_BYTES else right.hint("merge")
    met = left.join(right, [*on, "_node"]).filter(held).drop("_node")
    if how == "left":
        # rows of one key and value meet the same intervals
        some = met.select(*on, "_value").distinct()
        met = met.unionByName(tagged.join(some, [*on, "_value"], "left_anti"), allowMissingColumns=True)
    cols = [*df.columns, *[c for c in bands.columns if c not in on]]
    return met.select(*cols)


def interval_audit(df: DataFrame, lo: str = "lo", hi: str = "hi", on: list[str] | None = None,
                   step=0, partitions: int | None = None) -> DataFrame:
    """``(on..., lo, hi, n, prev_hi, issue)``: the intervals that start inside what
    came before them in their key (``overlap``) or more than ``step`` after all
    of it (``gap``). ``n`` counts equal intervals (two of them overlap);
    ``prev_hi`` is the greatest end before, NULL if that is open. ``step`` is the
    grid of the axis: 1 for whole numbers and days. Intervals with ``lo > hi``
    hold nothing and are left out.

    Equal intervals collapse first, in a partial aggregation. A key that holds
    a third of all intervals is spread over its range partitions: no window
    spans more than one of them, and what is carried between them is one row
    for each boundary that cuts a key.
    """
    spark = df.sparkSession
    shared_dir(spark)
    on = list(on or [])
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = (df.filter(F.coalesce(F.col(lo) <= F.col(hi), F.lit(True)))
           .groupBy(*on, F.col(lo).alias("lo"), F.col(hi).alias("hi")).agg(F.count(F.lit(1)).alias("n")))
    order = [F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_last()]
    ranged = (own.repartitionByRange(n, *[F.col(c) for c in on], *order).sortWithinPartitions(*on, *order)
              .withColumn("_part", F.spark_partition_id()).withColumn("_open", F.col("hi").isNull()).checkpoint(eager=True))

    def latest(over, top: str, is_open: str, part: str) -> list[Column]:
        """Greatest end of a window's rows, whether one is open, and whether it has any."""
        return [F.max(top).over(over).alias(f"{part}_top"), F.max(is_open).over(over).alias(f"{part}_open")]

    tops = ranged.groupBy("_part", *on).agg(F.max("hi").alias("_top"), F.max("_open").alias("_open"))
    before = Window.partitionBy(*(on or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one key reaches over each boundary between two partitions
    carried = (tops.select("_part", *on, *latest(before, "_top", "_open", "_c")).filter("_c_open is not null")
               .select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_on_{c}") for c in on], "_c_top", "_c_open"))
    same = F.col("_part") == F.col("_p")
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    within = Window.partitionBy("_part", *on).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.select("*", *latest(within, "hi", "_open", "_w")).join(F.broadcast(carried), same, "left")
    first = F.col("_w_open").isNull() & F.col("_c_open").isNull()
    is_open = F.coalesce(F.col("_w_open"), F.lit(False)) | F.coalesce(F.col("_c_open"), F.lit(False))
    prev = F.when(~is_open, F.greatest("_w_top", "_c_top"))
    beyond = (F.datediff("lo", prev) > step if isinstance(df.schema[lo].dataType, T.DateType)
              else F.col("lo") > prev + F.lit(step))
    issue = (F.when((F.col("n") > 1) | is_open | (~first & F.col("lo").isNull()) | (F.col("lo") <= prev), "overlap")
             .when(beyond, "gap"))
    return (rows.withColumn("issue", issue).filter("issue is not null")
            .select(*on, "lo", "hi", "n", F.when(first, F.col("hi")).otherwise(prev).alias("prev_hi"), "issue"))
