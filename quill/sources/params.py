"""Small parameter tables built from literal rows in the driver (band and
rate tables). Their size is the number of rows given here, which is what
makes broadcasting them safe."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quill.operators.joins import band_stats

D = decimal.Decimal


def exact(value) -> decimal.Decimal:
    """A parameter as the decimal number that was written: ``0.19``, ``"0.19"``
    and ``Decimal("0.19")`` are the same (a float by its shortest text)."""
    return value if isinstance(value, D) else D(str(value))


def band_table(spark: SparkSession, bands, edge_type: T.DataType = T.IntegerType(),
               rate_type: T.DataType = T.DecimalType(5, 2)) -> DataFrame:
    """``(lo, hi, rate)`` rows; decimal edges and rates given as text stay exact."""
    schema = T.StructType([T.StructField("lo", edge_type), T.StructField("hi", edge_type),
                           T.StructField("rate", rate_type)])
    conv = (lambda v: D(str(v))) if isinstance(edge_type, T.DecimalType) else (lambda v: v)
    return spark.createDataFrame([(conv(a), conv(b), D(r)) for a, b, r in bands], schema)


def literal_bands(spark: SparkSession, bands, **types) -> tuple[DataFrame, dict]:
    """:func:`band_table` plus its statistics for ``band_join(stats=…)``."""
    return band_table(spark, bands, **types), band_stats(bands)
