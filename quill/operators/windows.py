"""Latest row per entity: ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY d DESC) = 1``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: list[str], order_desc: list[str],
                   method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the first row by ``order_desc`` descending.

    ``order_desc`` must end with a unique tie-break column (the reference has
    none, so ties would be arbitrary). As in the reference dialect, a NULL
    sorts first in descending order, so it wins.

    ``aggregate`` (default) is a max over a struct of the sort keys and the
    row, with a partial phase: a hot key sends one row per map task. A struct
    is not a fixed-width buffer, so Spark plans sort aggregates (each side
    sorts by key). ``window`` is the literal ROW_NUMBER form; Spark adds
    a partial ``WindowGroupLimit`` before its shuffle, so it is also
    skew-safe, but it sorts each partition.
    """
    rest = [c for c in df.columns if c not in keys]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order_desc])
        return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
                .drop("_rn"))
    sort_fields = []
    for i, c in enumerate(order_desc):
        sort_fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    best = F.max(F.struct(*sort_fields, F.struct(*rest).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*")
