"""How many jobs the driver runs: each leaves it plans, classes and threads to hold."""
import random

from llm_helpers import sentence
from pyspark.sql import functions as F

from quill.llm import cluster
from quill.llm.common import BROADCAST_BYTES, keep_counted, keep_sized
from quill.llm.graph import components
from quill.llm.texts import word_shingles


def jobs(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    out = run()
    n = len(sc.statusTracker().getJobIdsForGroup(name))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, n


def test_stars_take_no_round(spark):
    edges = spark.createDataFrame([(c, c + k) for c in range(0, 50, 10) for k in range(1, 5)], "a long, b long").coalesce(1)
    out, n = jobs(spark, "stars", lambda: components(edges))
    assert n <= 5
    assert {tuple(x) for x in out.collect()} == {(c + k, c) for c in range(0, 50, 10) for k in range(5)}
    chain = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(77, 70), (70, 78), (78, 79)], "a long, b long")
    assert dict(map(tuple, components(chain).collect())) == {k: 0 for k in range(31)} | {k: 70 for k in (70, 77, 78, 79)}


def test_what_the_star_has_linked_is_not_compared_again(spark):
    r = random.Random(5)
    base = sentence(r, 60)
    rows = [(k, f"{base} {k}") for k in range(20)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    bucket = spark.createDataFrame([(1, k, 0) for k in range(20)], "key long, id long, centre long").coalesce(1)
    out, n = jobs(spark, "linked", lambda: cluster.clusters(bucket, texts, word_shingles, 75, 100))
    assert n <= 18
    assert {tuple(x) for x in out.collect()} == {(k, 0) for k in range(1, 20)}


def test_counts_come_with_the_rows(spark):
    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    kept, n = keep_counted(spark.range(1000), rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert n == {"rows": 1000, "odd": 500} and kept.count() == 1000
    for none in (spark.range(10).filter("id > 10"), spark.range(0), spark.range(9).groupBy("id").count().filter("count > 1")):
        kept, side, rows = keep_sized(none)
        assert rows == 0 and kept.count() == 0 and hinted(side) and side.collect() == []
    wide = spark.range(100).select("id", F.array_repeat(F.lit(1), 2 * BROADCAST_BYTES // 800).alias("drop"))
    kept, side, rows = keep_sized(wide, 128)
    assert rows == 100 and not hinted(side) and hinted(keep_sized(wide.select("id"))[1])
