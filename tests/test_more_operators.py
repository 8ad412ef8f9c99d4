"""Sparse keys, functional dependences, mergeable distinct counts, catalog views."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from quill.operators import block_keys, dependences
from quill.operators.sketches import distinct_sketches, merged_distinct
from quill.plans import basics, views
from quill.plans.context import Ctx
from quill.sources import TableStore
from quill.sources.catalog import Database

from conftest import SF_SMALL


@pytest.mark.parametrize("partitions,block", [(1, 4), (5, 4), (5, 1000)])
def test_block_keys_unique_on_step(spark, partitions, block):
    df = spark.range(0, 103, 1, partitions).withColumnRenamed("id", "v")
    keys = [r.key for r in block_keys(df, start=80, step=10, block=block).collect()]
    assert len(set(keys)) == 103 and min(keys) == 80 and all((k - 80) % 10 == 0 for k in keys)
    if block == 1000:        # no task needs a second block: bounded by blocks x tasks
        assert max(keys) < 80 + 10 * 1000 * partitions
    assert [r.key for r in block_keys(spark.range(0), start=5).collect()] == []


def test_sparse_inserts_never_collide_and_do_not_read_the_table(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="quill-sparse-"))
    store.create_empty("t", spark.createDataFrame([], "num long, v long").schema)
    assert store.high_water("t", "num") is None
    tops = []
    for k in range(4):
        store.append_sparse(spark.range(k * 100, k * 100 + 100, 1, 3).withColumnRenamed("id", "v"), "t", "num",
                            start=7, step=3, block=16)
        tops.append(store.high_water("t", "num"))
    store.append_sparse(spark.range(0).withColumnRenamed("id", "v"), "t", "num")       # nothing drawn
    assert store.high_water("t", "num") == tops[-1] and tops == sorted(set(tops))
    rows = store.read("t").collect()
    assert len({r.num for r in rows}) == len(rows) == 400 and all((r.num - 7) % 3 == 0 for r in rows)
    for k, (low, high) in enumerate(zip([6, *tops], tops)):
        assert all(low < r.num <= high for r in rows if r.v // 100 == k)
    # a failed insert draws nothing
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("v"))
    with pytest.raises(Exception, match="broken"):
        store.append_sparse(bad, "t", "num")
    assert store.high_water("t", "num") == tops[-1] and store.read("t").count() == 400


def test_dependences(spark):
    rows = [(1, "a", 1, None), (1, "a", 2, None), (2, "b", 1, 5), (2, "b", 1, None), (None, "c", 1, 1), (None, "d", 1, 1)]
    df = spark.createDataFrame(rows, "k int, follows string, varies int, holes int")
    got = {(r.key_column, r.column_name): (r.groups, r.n) for r in dependences(df, "t", ["k", "follows"]).collect()}
    assert got == {("k", "follows"): (3, 1), ("k", "varies"): (3, 1), ("k", "holes"): (3, 1),
                   ("follows", "k"): (4, 0), ("follows", "varies"): (4, 1), ("follows", "holes"): (4, 1)}
    plan = dependences(df, "t", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "SortAggregate" not in plan


def test_sketches_merge_for_any_range(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 10).alias("year"),
                                    F.when(F.col("id") % 7 > 0, F.col("id") % 20_011).alias("v"))
    saved = distinct_sketches(df, ["g", "year"], "v")
    assert saved.agg(F.max(F.octet_length("sketch"))).first()[0] <= 17_000
    for low in (0, 4, 9):
        exact = {r.g: r.n for r in df.filter(F.col("year") >= low).groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
        for r in merged_distinct(saved.filter(F.col("year") >= low), ["g"]).collect():
            assert abs(r.estimate - exact[r.g]) <= 0.03 * exact[r.g]


def test_views_outlive_the_session_and_take_the_run_date(spark):
    name = views.define_status_views(Ctx(spark, SF_SMALL)).name
    other = spark.newSession()
    before = other.catalog.currentDatabase()
    db = Database(other, name)
    assert db.view("order_days").count() == other.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    found = []
    for day in (dt.date(1998, 3, 1), dt.date(2001, 8, 15)):
        got = sorted(map(tuple, db.call("status_at", day).collect()))
        want = basics.latest_status(Ctx(spark, SF_SMALL, as_of=day)).select(
            "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
        assert got == sorted(map(tuple, want.collect()))
        found.append(got)
    assert found[0] != found[1]
    assert other.catalog.currentDatabase() == before
    plan = db.call("status_at", dt.date(2001, 8, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1999-08-17" in plan
    with pytest.raises(ValueError):
        db.view("x; drop table y")
