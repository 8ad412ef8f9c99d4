"""Surrogate keys from a sequence (``START WITH s INCREMENT BY i`` + ``NEXTVAL``).

A global ``row_number()`` window would pull every row into one task. Instead:

1. range-partition on the order plus a row hash (a repeated order value
   cannot pile into one partition) into as many partitions as the session
   shuffles into, sort within partitions on that total order, and checkpoint
   to the shared folder: the partitioning is frozen, so both passes below see
   the same rows in the same partitions even if an executor is lost;
2. ``monotonically_increasing_id`` gives (partition id, position) per row;
3. count rows per partition (one row per partition), turn the counts into
   running offsets, broadcast them (size bounded by the partition count) and
   add ``offset + position``.

Keys are dense, unique, start at ``start`` and follow the order. Nothing
depends on the number of rows: no count decides how the job is laid out.

A sequence that only has to be unique and rising between inserts needs none of
this: ``block_keys`` hands every task blocks of keys of its own, in one pass
without a shuffle, and leaves gaps where a block is not used up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quill.session import shared_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def assign_keys(df: DataFrame, order: list[str], key: str = "key", start: int = 1,
                step: int = 1, partitions: int | None = None) -> DataFrame:
    """Dense keys ``start, start+step, …`` following ``order``.

    ``partitions`` defaults to the session's ``spark.sql.shuffle.partitions``,
    which a cluster sets for its data."""
    spark = df.sparkSession
    shared_dir(spark)  # make sure the reliable checkpoint folder is set
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    ranged = (base.repartitionByRange(n, *[F.col(c) for c in order], F.col("_tie"))
              .sortWithinPartitions(*order, "_tie")
              .checkpoint(eager=True))
    mid = ranged.withColumn("_mid", F.monotonically_increasing_id())
    mid = (mid.withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)))
    counts = mid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = mid.join(F.broadcast(offsets), "_pid")
    keyed = F.lit(start) + F.lit(step) * (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos"))
    return out.select(keyed.cast("long").alias(key), *df.columns)


BLOCK, TASKS = 1 << 12, 1 << 17     # keys per block; tasks that can draw blocks at once


def block_keys(df: DataFrame, key: str = "key", start: int = 1, step: int = 1, block: int = BLOCK) -> DataFrame:
    """Sparse keys: ``start + step * i``, unique, in no order.

    The ``n``-th block of a task is number ``n * TASKS + task``, so tasks never
    meet and no one counts rows. As long as no task has more than ``block``
    rows, the keys stay below ``start + step * block * tasks``."""
    place = F.monotonically_increasing_id()
    task = F.shiftright(place, _POS_BITS)
    pos = place.bitwiseAND((1 << _POS_BITS) - 1)
    fits = F.when(task < TASKS, task).otherwise(F.raise_error(F.lit(f"more than {TASKS} tasks draw keys")).cast("long"))
    number = (F.floor(pos / block).cast("long") * TASKS + fits) * block + F.pmod(pos, F.lit(block))
    return df.select((F.lit(start) + F.lit(step) * number).cast("long").alias(key), *df.columns)
