"""Set operations on key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a INTERSECT b`` (distinct, NULLs equal), in one shuffle.

    Both inputs are tagged, unioned and grouped on all columns; a group is
    kept when both tags occur. Each side is partially aggregated first, so a
    repeated key costs one row per map task (``DataFrame.intersect`` would
    plan a semi join plus an aggregate: two shuffles).
    """
    cols = a.columns
    tagged = (a.select(*cols, F.lit(True).alias("_in_a"), F.lit(False).alias("_in_b"))
              .unionByName(b.select(*cols, F.lit(False).alias("_in_a"),
                                    F.lit(True).alias("_in_b"))))
    return (tagged.groupBy(*cols)
            .agg(F.bool_or("_in_a").alias("_a"), F.bool_or("_in_b").alias("_b"))
            .filter(F.col("_a") & F.col("_b")).select(*cols))
