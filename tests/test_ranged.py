"""Updates that rewrite only the key ranges they touch."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quill.sources import TableStore
from quill.sources.ranged import RANGE, RangedTable
from quill.sources.sinks import TableBusy


@pytest.fixture()
def table(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="quill-ranged-"))
    t = RangedTable(store, "t", "k")
    rows = [(k, k % 7, None) for k in range(1000)] + [(500, 99, 1)] * 300 + [(None, 5, 5)]
    random.Random(3).shuffle(rows)
    t.create(spark.createDataFrame(rows, "k long, a int, b int"), ranges=8)
    return t


def _files(t):
    return {os.path.join(d, f) for d, _, names in os.walk(t.path) for f in names if f.endswith(".parquet")}


def _rows(t, ranges=None):
    df = t._scan()
    return df.filter(F.col(RANGE).isin(list(ranges))).count() if ranges is not None else df.count()


def test_literal_update_writes_the_touched_ranges_only(table):
    before, content = _files(table), table.read().collect()
    got = table.update_where(({"b": F.lit(7)}, F.col("k") <= 40), ({"b": F.lit(8)}, F.col("k").between(30, 60)))
    want = [(k, a, 8 if k is not None and 30 <= k <= 60 else 7 if k is not None and k <= 40 else b) for k, a, b in content]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    touched = table.last
    assert len(touched.ranges) == 1 and touched.rows == _rows(table, touched.ranges) < 200
    changed = before ^ _files(table)
    assert changed and all(f"{RANGE}={touched.ranges[0]}/" in f for f in changed)


def test_second_predicate_sees_the_first(table):
    table.update_where(({"b": F.lit(1000)}, F.col("k") == 5), ({"a": F.lit(-1)}, F.col("b") == 1000))
    assert table.read().filter("a = -1").select("k").collect() == [(5,)]


def test_no_hit_writes_nothing(table):
    before = _files(table)
    table.update_where(({"b": F.lit(7)}, F.col("k") < -5))
    assert table.last.ranges == () and table.last.rows == 0 and _files(table) == before


def test_update_from_aggregate_finds_ranges_by_key(spark, table):
    content = table.read().collect()
    agg = spark.createDataFrame([(3, 30), (4, 40), (500, 50), (5000, 1), (None, 2)], "key long, s int")
    got = table.update_from_aggregate(agg, "key", {"b": F.col("s")})
    new = {3: 30, 4: 40, 500: 50}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, a, new.get(k, b)) for k, a, b in content), key=str)
    assert table.last.rows == _rows(table, table.last.ranges) < _rows(table)
    holding = {r[0] for r in table._scan().filter(F.col("k").isin(3, 4, 500)).select(RANGE).distinct().collect()}
    assert holding == set(table.last.ranges)
    plan = table.ranges_of(agg.select("key"))._jdf.queryExecution().executedPlan().toString()
    assert table.path not in plan                       # the table itself is not read


def test_failed_job_leaves_the_old_content(table):
    before, content = _files(table), sorted(map(tuple, table.read().collect()), key=str)
    bad = F.when(F.col("a") == 99, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.lit(1))
    with pytest.raises(Exception, match="broken"):
        table.update_where(({"b": bad}, F.col("k") >= 0))
    assert sorted(map(tuple, table.read().collect()), key=str) == content
    assert _files(table) == before
    table.update_where(({"b": F.lit(3)}, F.col("k") == 0))          # the claim is free again
    assert table.read().filter("k = 0").first().b == 3


def test_one_writer_and_no_key_update(table):
    with table.store._writer("t"), pytest.raises(TableBusy):
        table.update_where(({"b": F.lit(1)}, F.col("k") == 1))
    with pytest.raises(ValueError):
        table.update_where(({"k": F.lit(1)}, F.col("k") == 1))


def test_predicate_on_the_key_is_pushed_and_folders_pruned(table):
    probe = table._scan().withColumn("_hit", F.lit(False) | (F.col("k") <= 40)).filter("_hit").select(RANGE)
    assert "LessThanOrEqual(k,40)" in probe._jdf.queryExecution().executedPlan().toString()
