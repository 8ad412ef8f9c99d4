from pyspark.sql import functions as F

from quill.llm.common import BROADCAST_BYTES, sized


def hinted(df):
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_arrays_and_texts_are_measured(spark):
    rows = spark.range(100)
    wide = 2 * BROADCAST_BYTES // 100
    assert hinted(sized(rows, 128)) and hinted(sized(rows.select("id", F.array("id")), 128))
    assert not hinted(sized(rows.select("id", F.array_repeat(F.lit(1), wide // 8).alias("drop")), 128))
    pair = F.array_repeat(F.struct("id", "id"), wide // 32)
    assert not hinted(sized(rows.select("id", pair.alias("wanted")), 128))
    assert not hinted(sized(rows.select("id", F.array(F.repeat(F.lit("x"), wide)).alias("need")), 128))
    assert hinted(sized(rows.select("id", F.lit(None).cast("array<string>").alias("need")), 128))
