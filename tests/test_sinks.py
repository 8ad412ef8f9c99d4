"""Table sinks: versions, create-as, append by name, reload, rewrite."""

import decimal
import tempfile

import pytest
from pyspark.sql import functions as F

from quill.sources import TableStore
from quill.sources.sinks import RuleViolation

D = decimal.Decimal


@pytest.fixture()
def store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="quill-store-"))


def test_versions_and_rewrite(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.create_as(df, "t")
    assert store.versions("t") == [1]
    out = store.replace_with(lambda t: t.withColumn("v", F.upper("v")), "t")
    assert store.versions("t") == [1, 2]
    assert sorted(map(tuple, out.collect())) == [(1, "A"), (2, "B")]
    old = spark.read.parquet(store._version_path("t", 1) + "/p000001")
    assert sorted(r.v for r in old.collect()) == ["a", "b"]


def test_append_aligns_by_name(spark, store):
    store.create_empty("t", spark.createDataFrame([], "k int, v string").schema)
    swapped = spark.createDataFrame([("x", 7)], "v string, k long")
    out = store.append(swapped, "t")
    assert [tuple(r) for r in out.collect()] == [(7, "x")]
    with pytest.raises(ValueError):
        store.append(spark.createDataFrame([(1,)], "other int"), "t")


def test_reload_truncates(spark, store):
    store.create_as(spark.createDataFrame([(1,), (2,)], "k int"), "t")
    out = store.reload(spark.createDataFrame([(3,)], "k int"), "t")
    assert [r.k for r in out.collect()] == [3]


def test_create_without_replace_refuses(spark, store):
    store.create_as(spark.createDataFrame([(1,)], "k int"), "t")
    with pytest.raises(FileExistsError):
        store.create_as(spark.createDataFrame([(1,)], "k int"), "t", replace=False)


def test_failed_version_is_skipped(spark, store):
    import os
    store.create_as(spark.createDataFrame([(1,)], "k int"), "t")
    # a job that died mid-write: folder without the commit marker
    os.makedirs(store._version_path("t", 2).replace("file:", ""), exist_ok=True)
    assert store.versions("t") == [1]
    assert [r.k for r in store.read("t").collect()] == [1]
    out = store.create_as(spark.createDataFrame([(3,)], "k int"), "t")
    assert store.versions("t") == [1, 3] and [r.k for r in out.collect()] == [3]


def test_append_keyed_continues_the_sequence(spark, store):
    store.create_empty("t", spark.createDataFrame([], "num long, v string").schema)
    first = spark.createDataFrame([("b",), ("a",)], "v string")
    store.append_keyed(first, "t", key="num", order=["v"], start=80)
    second = spark.createDataFrame([("d",), ("c",)], "v string")
    out = store.append_keyed(second, "t", key="num", order=["v"], start=80)
    assert sorted(map(tuple, out.collect())) == [(80, "a"), (81, "b"), (82, "c"), (83, "d")]


@pytest.mark.parametrize("name", ["append_bonus_detail", "update_literal", "update_by_aggregate",
                                  "reload_payroll", "ctas_stock", "layout_year_pruned"])
def test_writer_queries_are_repeatable(spark, name):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from tools.compare import rows_key
    first = E.queries()[name](spark, SF_SMALL)
    a = rows_key(first.columns, first.collect())
    second = E.queries()[name](spark, SF_SMALL)
    assert rows_key(second.columns, second.collect()) == a


def test_keyed_layout_files_cover_disjoint_key_ranges(spark, store, ctx):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from quill.sources.layout import keyed_by
    keyed_by(store, ctx.t.part, "parts", "name_key", F.upper("p_name"), partitions=4)
    ranges = []
    for f in glob.glob(store.current_paths("parts")[0].replace("file:", "") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        col = [i for i in range(meta.num_columns) if meta.schema.column(i).name == "name_key"][0]
        for rg in range(meta.num_row_groups):
            st = meta.row_group(rg).column(col).statistics
            if st is not None and st.has_min_max:
                ranges.append((st.min, st.max))
    assert len(ranges) >= 2
    ranges.sort()
    # range clustering: each file's keys start at or after the previous file's end
    # (a key shared by two files can only be a boundary value)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_vacuum_keeps_newest_and_running(spark, store):
    import os
    for i in range(4):
        store.create_as(spark.createDataFrame([(i,)], "k int"), "t")
    os.makedirs(store._version_path("t", 5).replace("file:", ""))   # a write in progress
    assert store.vacuum("t", keep=2) == [1, 2]
    assert store.versions("t") == [3, 4]
    assert [r.k for r in store.read("t").collect()] == [3]
    assert os.path.isdir(store._version_path("t", 5).replace("file:", ""))


def bad_rows(spark):
    """Rows whose writing fails half way: one partition is fine, another raises."""
    return (spark.range(0, 1000, 1, 4).withColumn("k", F.col("id").cast("int"))
            .select(F.when(F.col("k") < 700, F.col("k")).otherwise(F.raise_error(F.lit("broken"))).cast("int").alias("k")))


def test_failed_append_shows_nothing_and_retry_does_not_double(spark, store):
    store.create_as(spark.createDataFrame([(1,), (2,)], "k int"), "t")
    with pytest.raises(Exception, match="broken"):
        store.append(bad_rows(spark), "t")
    assert sorted(r.k for r in store.read("t").collect()) == [1, 2]
    more = spark.createDataFrame([(3,)], "k int")
    assert sorted(r.k for r in store.append(more, "t").collect()) == [1, 2, 3]
    assert store.versions("t") == [1]


def test_second_writer_fails(spark, store):
    from quill.sources.sinks import TableBusy
    store.create_empty("t", spark.createDataFrame([], "num long, v string").schema)
    rows = spark.createDataFrame([("a",)], "v string")
    with store._writer("t"):
        for write in (lambda: store.append(rows, "t"), lambda: store.create_as(rows, "t"),
                      lambda: store.append_keyed(rows, "t", key="num", order=["v"])):
            with pytest.raises(TableBusy):
                write()
    out = store.append_keyed(rows, "t", key="num", order=["v"])
    assert [tuple(r) for r in out.collect()] == [(1, "a")]
    with pytest.raises(RuntimeError):
        with store._writer("t"):
            raise RuntimeError("dies")
    store.append(spark.createDataFrame([(9, "z")], "num long, v string"), "t")     # the claim was released


def test_root_is_the_same_on_every_call(spark):
    from quill.session import shared_dir, table_root
    assert table_root(spark) == table_root(spark) and shared_dir(spark) == shared_dir(spark)
    assert TableStore(spark).root == table_root(spark)


def test_year_layout_writes_few_files(spark, store, ctx):
    import glob

    from quill.sources.layout import partitioned_by
    t = ctx.t.orders.repartition(40)
    partitioned_by(store, t, "o", "y", F.year("o_orderdate"), ["o_orderdate"], files=2)
    for folder in glob.glob(store.current_paths("o")[0].replace("file:", "") + "/y=*"):
        assert 1 <= len(glob.glob(folder + "/*.parquet")) <= 2


def _rules():
    return {"not_null:v": F.col("v").isNotNull(), "short:v": F.length("v") <= 3, "even:k": F.col("k") % 2 == 0}


def test_rules_are_audited_by_the_writing_job(spark, store):
    good = spark.createDataFrame([(2, "a"), (4, "abc")], "k int, v string")
    bad = spark.createDataFrame([(1, "abcd"), (3, None), (None, "x"), (2, "y")], "k int, v string")
    store.create_as(good, "t", rules=_rules())
    assert store.audited == {"not_null:v": 0, "short:v": 0, "even:k": 0}
    for write in (store.create_as, store.append, store.reload):
        with pytest.raises(RuleViolation) as e:
            write(bad, "t", rules=_rules())
        # NULL passes a CHECK, not a NOT NULL
        assert e.value.counts == {"not_null:v": 1, "short:v": 1, "even:k": 2}
        assert sorted(map(tuple, store.read("t").collect())) == [(2, "a"), (4, "abc")]
    store.append(spark.createDataFrame([(6, "q")], "k int, v string"), "t", rules=_rules())
    assert store.read("t").count() == 3
    store.append(bad, "t", rules=_rules(), enforce=False)
    assert store.read("t").count() == 7 and store.audited["even:k"] == 2
    # what was refused is gone, and the claim is free
    assert store.versions("t") == [1]


def test_audited_write_is_one_job(spark, store):
    sc = spark.sparkContext
    sc.setJobGroup("audited", "one write")
    try:
        store.create_as(spark.range(100).withColumn("v", F.lit("x")), "u", rules={"positive:id": F.col("id") >= 0})
        assert len(sc.statusTracker().getJobIdsForGroup("audited")) <= 2      # the write; the schema of what it wrote
    finally:
        sc._jsc.sc().clearJobGroup()
