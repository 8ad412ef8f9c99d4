import random
import tempfile

import corpus_pipeline as P
import pytest
from llm_helpers import sentence
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quill.llm.neardup import near_duplicates
from quill.llm.queries import QUERIES


def test_contract():
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    assert "pipeline" in entry.queries() and set(QUERIES) <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    before = docs.count()
    good = P.quality(spark, docs, sf_small).cache()
    lines = P.line_dedup(spark, good, sf_small).cache()
    single = P.near_dedup(spark, lines, sf_small).cache()
    mixed = P.mixing(spark, single, sf_small).cache()
    for out in (good, lines, single, mixed):
        assert out.schema == docs.schema or out.dtypes == docs.dtypes
    assert 0 < good.count() < before and single.count() < lines.count() <= good.count()
    # of the documents that are near-duplicates as a whole, one of each group is left
    whole = docs.join(lines.select("doc_id"), "doc_id", "left_semi")
    copies = near_duplicates(whole).filter("not kept").select("doc_id")
    assert copies.count() > 0 and single.join(copies, "doc_id").count() == 0
    assert lines.filter(F.length("text") != F.col("n_chars")).count() == 0
    kept = single.join(good.select("doc_id", F.col("text").alias("was")), "doc_id")
    assert kept.filter("text <> was").count() > 0
    packed = P.packing(spark, mixed, sf_small)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_near_copies_go_whole_after_their_lines_are_cut(spark):
    """Near copies that share most lines: the cut leaves stubs that are like nothing."""
    r = random.Random(3)
    rows = []
    for g in range(6):
        lines = [sentence(r, 14) for _ in range(12)]
        for k in range(4):
            own = [*lines]
            if k:
                own[r.randrange(12)] = sentence(r, 14)
            rows.append((g * 10 + k, "\n".join(own), "en", "s", len("\n".join(own))))
    rows += [(100 + k, "\n".join(sentence(r, 14) for _ in range(8)), "en", "s", 9) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = tempfile.mkdtemp(prefix="quill-pipeline-")
    docs.write.parquet(f"{folder}/documents.parquet")
    lines = P.line_dedup(spark, docs, folder).cache()
    assert lines.count() == len(rows)                     # stubs of the copies are still there
    left = {x.doc_id for x in P.near_dedup(spark, lines, folder).collect()}
    assert left == {g * 10 for g in range(6)} | {100 + k for k in range(10)}
    # documents of another table under the same ids are judged by what they are
    other = docs.withColumn("source", F.lit("elsewhere")).withColumn("text", F.concat(F.lit("x "), F.col("doc_id").cast("string")))
    assert P.near_dedup(spark, other, folder).count() == len(rows)


def test_run_equals_its_stages(spark, sf_small):
    out = P.run(spark, sf_small)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_small)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, docs.select(cols).collect()))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_nasty(spark, nasty, name, stage, sf_small):
    out = stage(spark, nasty, sf_small)
    out.collect()
    if name != "packing":
        assert out.columns == nasty.columns
    assert stage(spark, nasty.limit(0), sf_small).collect() == []
