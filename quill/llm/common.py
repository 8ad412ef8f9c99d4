"""Helpers shared by the operators: lineage cuts, size-checked joins, Arrow passes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.session import shared_dir

BATCH_ROWS = 512              # texts per Arrow batch: bounds a Python worker's memory
BROADCAST_BYTES = 10 << 20    # a side is broadcast only if measured below this (Spark's own default)


def keep(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there: the
    rows survive the loss of an executor and are computed once.

    A table rather than ``checkpoint()``: the plan that reads it knows its real
    size. A checkpoint carries the estimate of the plan it cut off, and in
    rounds of joins these estimates multiply without bound. The tables lie in
    ``<spark.checkpoint.dir>/quill-kept/<application>``; like checkpoints they
    can go when the application has ended. ``options`` go to the Parquet writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quill-kept/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with small batches (texts can be very long)."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def _bytes(col: Column, kind: T.DataType) -> Column | None:
    """Bytes of a value beyond its place in the row; None if it has no such."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.octet_length(col)
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        fixed = 8 * (len(inner.fields) + 2) if isinstance(inner, T.StructType) else 8
        if _bytes(F.lit(None), inner) is None:
            return F.size(col) * (4 if isinstance(inner, T.IntegerType) else fixed)
        return F.aggregate(col, F.lit(0).cast("long"),
                           lambda total, x: total + fixed + F.coalesce(_bytes(x, inner), F.lit(0)))
    return None


def _measures(df: DataFrame) -> tuple[Column, Column]:
    """The number of rows and the bytes of their columns of any length."""
    more = [F.coalesce(b.cast("long"), F.lit(0)) for f in df.schema
            if (b := _bytes(F.col(f.name), f.dataType)) is not None]
    return F.count(F.lit(1)), F.coalesce(F.sum(sum(more, F.lit(0).cast("long"))), F.lit(0))


def sized(df: DataFrame, row_bytes: int = 24, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already kept), marked for broadcast if its rows are measured to fit in
    ``limit`` bytes; otherwise as it is, and the join shuffles both sides. Columns
    of any length (arrays, texts) are summed up, ``row_bytes`` is a row without them."""
    rows, size = df.agg(*_measures(df)).first()
    return F.broadcast(df) if rows * row_bytes + size <= limit else df


def keep_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``keep(df)``, and these aggregates of its rows, taken while they are written:
    a job less, and so less of the driver's memory, than to ask the table for them."""
    seen = Observation()
    kept = keep(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return kept, seen.get


def keep_sized(df: DataFrame, row_bytes: int = 24, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """``keep(df)``, the same as ``sized`` marks it, and its number of rows."""
    rows, size = _measures(df)
    kept, n = keep_counted(df, rows=rows, size=size)
    return kept, F.broadcast(kept) if n["rows"] * row_bytes + n["size"] <= limit else kept, n["rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
