import math

import pytest
from pyspark.sql import functions as F

from quill.llm.mixing import mix, poisson_cdf, rates


def docs(spark, n=6000):
    return (spark.range(n).select(F.col("id").alias("doc_id"),
                                  F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b")
                                  .when(F.col("id") % 30 == 2, None).otherwise("c").alias("source"),
                                  F.repeat(F.lit("x"), (10 + F.col("id") % 50).cast("int")).alias("text")))


def test_inverse_of_poisson():
    for rate in (0.0, 0.01, 0.7, 3.0, 40.0, 500.0):
        cdf = poisson_cdf(rate)
        assert cdf == sorted(cdf) and cdf[-1] > 1 - 1e-12 and cdf[0] == math.exp(-rate)
        mean = sum(k * (c - (cdf[k - 1] if k else 0)) for k, c in enumerate(cdf))
        assert mean == pytest.approx(rate, rel=1e-9, abs=1e-12)


def test_targets_are_met(spark):
    d = docs(spark)
    out = mix(d, {"hot": 0.1, "b": 0.5}, 0.4)
    total = d.agg(F.sum(F.length("text"))).first()[0]
    got = {r["s"]: r["n"] / total for r in out.groupBy(
        F.when(F.col("source").isin("hot", "b"), F.col("source")).otherwise("rest").alias("s"))
        .agg(F.sum(F.length("text")).alias("n")).collect()}
    assert got["hot"] == pytest.approx(0.1, abs=0.02) and got["b"] == pytest.approx(0.5, abs=0.03)
    assert got["rest"] == pytest.approx(0.4, abs=0.03)
    # copies are numbered, counts vary like Poisson's
    n = [r["n"] for r in out.filter("source = 'b'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    rate = dict(rates(d, {"hot": 0.1, "b": 0.5}, 0.4))["b"]
    assert 2000 * (1 - math.exp(-rate)) == pytest.approx(len(n), rel=0.08)
    assert out.groupBy("doc_id").agg((F.max("copy") - F.count("*")).alias("d")).filter("d <> -1").count() == 0


def test_reproducible_and_shuffled(spark):
    d = docs(spark, 900)
    a = [tuple(r) for r in mix(d, {"hot": 1.0}, 1.0).collect()]
    b = [tuple(r) for r in mix(d.repartition(7), {"hot": 1.0}, 1.0).collect()]
    assert sorted(a, key=str) == sorted(b, key=str)
    ids = [r[0] for r in a]
    assert sum(abs(x - y) for x, y in zip(ids, ids[1:])) / len(ids) > 200      # neighbours are far apart
    assert sorted(mix(d, {"hot": 1.0}, 1.0, seed=9).toPandas()["doc_id"]) != sorted(ids)


def test_zero_and_refused_weights(spark):
    d = docs(spark, 300)
    assert mix(d, {"hot": 0.0}, 1.0).filter("source = 'hot'").count() == 0
    with pytest.raises(ValueError):
        mix(d, {"hot": -1.0}, 1.0)
    with pytest.raises(ValueError):
        mix(d, {}, 0.0)
    # a tiny source with a large weight: the rate is far beyond one draw
    tiny = d.unionByName(spark.createDataFrame([(10 ** 6, "tiny", "xxxxx")], "doc_id long, source string, text string"))
    rate = dict(rates(tiny, {"tiny": 0.5}, 0.5))["tiny"]
    assert rate > 900
    assert mix(tiny, {"tiny": 0.5}, 0.5).filter("source = 'tiny'").count() == pytest.approx(rate, rel=0.15)


def test_nasty(spark, nasty):
    out = mix(nasty, {"s": 0.5}, 0.5)
    assert out.columns == [c for c in nasty.columns if c != "copy"] + ["copy", "shuffle_key"]
    counts = {}
    for r in out.filter("doc_id = 1").collect():
        counts[r["copy"]] = counts.get(r["copy"], 0) + 1
    assert set(counts.values()) <= {2}                       # repeated rows draw alike
    assert mix(nasty.limit(0), {"s": 1.0}).collect() == []
    many = mix(nasty, {"s": 0.5}, 0.5, seed=3).unionByName(mix(nasty, {"s": 0.5}, 0.5, seed=4))
    assert many.filter("doc_id is null").count() >= 0
