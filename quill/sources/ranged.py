"""Tables cut into key ranges, for updates that rewrite only what they touch.

``UPDATE`` on a Parquet table is a rewrite. Here the table is range-partitioned
on its key into folders ``_range=N`` of about equal size, sorted by key within,
and an update replaces the folders of the ranges it touches by Spark's dynamic
partition overwrite; all other files stay as they are. Which ranges an update
touches is found from its predicate (pushed to the scan: row groups outside it
are skipped) or, when it comes with a set of keys, from the first and last key
of every range, without reading the table.

The new files are staged and put in place when the whole job has succeeded: a
job that fails before that leaves the table as it was. One writer at a time
(the claim of the table store). Keys are not updated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quill.operators.intervals import interval_join
from quill.operators.mutate import update_from_aggregate, update_where
from quill.sources.sinks import TableStore

RANGE = "_range"


@dataclass(frozen=True)
class Written:
    """What an update wrote: its ranges, and their rows (all of them, changed or not)."""
    ranges: tuple[int, ...] = ()
    rows: int = 0


class RangedTable:
    def __init__(self, store: TableStore, name: str, key: str):
        self.store, self.name, self.key = store, name, key
        self.path = f"{store.root}/{name}/ranges"
        self.edges = f"{store.root}/{name}/edges"
        self.last = Written()

    def create(self, df: DataFrame, ranges: int | None = None) -> DataFrame:
        """``CREATE TABLE`` with the rows of ``df``. A key that very many rows share
        may span several ranges: a row hash follows it in the partitioning."""
        n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = (df.repartitionByRange(n, F.col(self.key), F.xxhash64(*df.columns))
                 .withColumn(RANGE, F.spark_partition_id()))
        with self.store._writer(self.name):
            self._write(dealt, "static")
            first_last = self._scan().groupBy(RANGE).agg(F.min(self.key).alias("first"), F.max(self.key).alias("last"))
            first_last.coalesce(1).write.mode("overwrite").parquet(self.edges)     # a row per range
        return self.read()

    def _write(self, df: DataFrame, mode: str) -> None:
        (df.sortWithinPartitions(RANGE, self.key).write.mode("overwrite").option("partitionOverwriteMode", mode)
         .partitionBy(RANGE).parquet(self.path))

    def _scan(self) -> DataFrame:
        return self.store.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._scan().drop(RANGE)

    def ranges_of(self, keys: DataFrame) -> DataFrame:
        """``(_range)``: the ranges that may hold one of ``keys`` (first column)."""
        bands = self.store.spark.read.parquet(self.edges)
        keys = keys.select(F.col(keys.columns[0]).alias("_key"))
        return interval_join(keys, "_key", bands, "first", "last").select(RANGE).distinct()

    def _rewrite(self, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Written:
        ids = sorted(r[0] for r in touched.collect())        # at most a row per range
        self.last = Written()
        if ids:
            seen = Observation()
            old = self._scan().filter(F.col(RANGE).isin(ids))       # partition pruning: these folders only
            new = change(old).repartitionByRange(len(ids), RANGE).observe(seen, F.count(F.lit(1)).alias("rows"))
            self._write(new, "dynamic")
            self.last = Written(tuple(ids), seen.get["rows"])
        return self.last

    def _refuse_key(self, columns) -> None:
        if self.key in columns:
            raise ValueError(f"the key {self.key!r} of a ranged table cannot be updated")

    def update_where(self, *steps: tuple[dict[str, Column], Column]) -> DataFrame:
        """``UPDATE … SET … WHERE …``: one or several, applied in order, one commit;
        a later predicate sees what earlier steps have set."""
        for assignments, _ in steps:
            self._refuse_key(assignments)

        def change(t: DataFrame) -> DataFrame:
            for assignments, where in steps:
                t = update_where(t, assignments, where)
            return t

        # the steps over their own columns; Catalyst folds them into one filter
        touched = self._scan().withColumn("_hit", F.lit(False))
        for assignments, where in steps:
            touched = update_where(touched.withColumn("_hit", F.col("_hit") | where), assignments, where)
        with self.store._writer(self.name):
            self._rewrite(touched.filter("_hit").select(RANGE).distinct(), change)
        return self.read()

    def update_from_aggregate(self, agg: DataFrame, agg_key: str, assignments: dict[str, Column]) -> DataFrame:
        """``UPDATE … SET c = f(<correlated aggregate>) WHERE EXISTS (<same rows>)``:
        ``agg`` holds a row per key, its keys name the ranges."""
        self._refuse_key(assignments)
        with self.store._writer(self.name):
            self._rewrite(self.ranges_of(agg.select(agg_key)),
                          lambda t: update_from_aggregate(t, self.key, agg, agg_key, assignments))
        return self.read()
