"""Row updates as rewrites (``UPDATE t SET ... WHERE ...``).

Each function returns the *new content* of the table; ``TableStore`` commits
it as the next version. All SET expressions read the old row values, as SQL
requires (a chain of ``withColumn`` would let a later one see an earlier one).
A new value is cast to the column's type before the two meet, so that the type
of an expression never changes the rows that the update does not touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_where(df: DataFrame, assignments: dict[str, Column], where: Column) -> DataFrame:
    """``UPDATE df SET c1 = e1, ... WHERE where`` (NULL predicate = no update)."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[
        (F.when(hit, assignments[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        if c in assignments else F.col(c)
        for c in df.columns])


def update_from_aggregate(df: DataFrame, key: str, agg: DataFrame, agg_key: str,
                          assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE df SET c = f(<correlated aggregate>) WHERE EXISTS (<same rows>)``.

    ``agg`` holds one row per key (the correlated subquery, decorrelated and
    aggregated once); rows with no aggregate row are left unchanged. The
    assignments may use ``agg``'s columns.
    """
    marked = agg.withColumn("_exists", F.lit(True))
    joined = df.join(marked, df[key] == marked[agg_key], "left")
    hit = F.coalesce(F.col("_exists"), F.lit(False))
    return joined.select(*[
        (F.when(hit, assignments[c].cast(df.schema[c].dataType)).otherwise(df[c]).alias(c))
        if c in assignments else df[c]
        for c in df.columns])
