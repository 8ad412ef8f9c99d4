"""Operators on small fixtures: band joins, KEEP, latest row, intersect,
keys, updates, audits (SURVEY §5 items 3-4)."""

import decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quill.operators import (assign_keys, band_audit, band_join, check_rules, cond_count,
                             cond_sum, duplicate_keys, filtered_left_join, intersect_distinct,
                             keep_last, keep_last_key, latest_per_key, null_counts, orphans,
                             update_from_aggregate, update_where)

D = decimal.Decimal


def test_band_join_overlap_and_gap(spark):
    bands = spark.createDataFrame([(0, 9, "a"), (10, 12, "b"), (13, 16, "c"), (16, 30, "d")],
                                  "lo int, hi int, tag string")
    vals = spark.createDataFrame([(v,) for v in [0, 9, 12, 16, 31, -1, None]], "v int")
    out = sorted((r.v, r.tag) for r in band_join(vals, F.col("v"), bands).collect())
    assert out == [(0, "a"), (9, "a"), (12, "b"), (16, "c"), (16, "d")]
    left = band_join(vals, F.col("v"), bands, how="left")
    assert left.count() == 8  # 5 matches + 31, -1, NULL kept


def test_band_join_decimal_edges(spark):
    bands = spark.createDataFrame([(D("-1000"), D("1999.99"), 5), (D("2000"), D("5999.99"), 10)],
                                  "lo decimal(18,2), hi decimal(18,2), rate int")
    vals = spark.createDataFrame([(D(x),) for x in ["1999.99", "1999.995", "2000", "6000"]],
                                 "v decimal(18,3)")
    out = sorted((str(r.v), r.rate) for r in band_join(vals, F.col("v"), bands).collect())
    assert out == [("1999.990", 5), ("2000.000", 10)]


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.integers(-50, 150), min_size=1, max_size=40),
       bands=st.lists(st.tuples(st.integers(-20, 120), st.integers(0, 40)), min_size=1,
                      max_size=6))
def test_band_join_counts_property(spark, values, bands):
    rows = [(lo, lo + w, i) for i, (lo, w) in enumerate(bands)]
    bdf = spark.createDataFrame(rows, "lo int, hi int, id int")
    vdf = spark.createDataFrame([(v,) for v in values], "v int")
    expected = sum(1 for v in values for lo, hi, _ in rows if lo <= v <= hi)
    assert band_join(vdf, F.col("v"), bdf, target_buckets=7).count() == expected


def test_band_audit(spark):
    bands = spark.createDataFrame([(0, 9), (10, 12), (13, 16), (16, 30), (35, 40)], "lo int, hi int")
    out = sorted((r.lo, r.prev_hi, r.issue) for r in band_audit(bands, step=1).collect())
    assert out == [(16, 16, "overlap"), (35, 30, "gap")]


def test_keep_last_ties_and_nulls(spark):
    rows = [(1, 10, D(5)), (1, 11, D(5)), (1, 9, D(3)),   # tie on max → max id 11
            (2, 20, D(7)), (2, 21, None), (2, 19, None),  # NULL ranks last → 21
            (3, 30, None)]
    df = spark.createDataFrame(rows, "k int, id int, amount decimal(10,0)")
    for keep in (keep_last, keep_last_key):
        out = {r.k: (r.best, r.mx) for r in df.groupBy("k").agg(
            keep("id", "amount").alias("best"), F.max("amount").alias("mx")).collect()}
        assert out == {1: (11, D(5)), 2: (21, D(7)), 3: (30, None)}


def test_keep_last_null_and_negative_keys(spark):
    rows = [(1, None, 10), (1, 7, 5), (2, None, 10), (2, -3, 10), (2, -4, 10), (3, -2 ** 63, 1), (3, None, 1),
            (4, 0, None), (4, 9, 8), (5, None, None), (5, 1, 2), (6, -1, -5), (6, 8, -6)]
    df = spark.createDataFrame(rows, "k int, id long, amount long")
    want = {1: None, 2: -3, 3: -2 ** 63, 4: 0, 5: None, 6: -1}
    for keep in (keep_last, keep_last_key):
        assert {r.k: r.best for r in df.groupBy("k").agg(keep("id", "amount").alias("best")).collect()} == want


def test_keep_last_key_extremes_and_plan(spark):
    big = 10 ** 18 - 1
    df = spark.createDataFrame([(1, 2 ** 63 - 1, D(big)), (1, 0, D(big - 1)), (2, 5, D(-big)), (2, 4, D(-big))],
                               "k int, id long, amount decimal(18,0)")
    agg = df.groupBy("k").agg(keep_last_key("id", "amount").alias("best"))
    assert {r.k: r.best for r in agg.collect()} == {1: 2 ** 63 - 1, 2: 5}
    text = agg._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Sort [" not in text


def test_latest_per_key_methods_agree(spark):
    rows = [(1, "2000-01-01", 5, "F"), (1, "2001-01-01", 6, "O"), (1, "2001-01-01", 7, "P"),
            (2, None, 8, "O"), (2, "1999-01-01", 9, "F"), (3, "1998-01-01", 1, "F")]
    df = spark.createDataFrame(rows, "k int, d string, key int, s string").withColumn(
        "d", F.to_date("d"))
    agg = sorted(map(tuple, latest_per_key(df, ["k"], ["d", "key"]).select("k", "key", "s").collect()))
    win = sorted(map(tuple, latest_per_key(df, ["k"], ["d", "key"], method="window")
                     .select("k", "key", "s").collect()))
    assert agg == win == [(1, 7, "P"), (2, 8, "O"), (3, 1, "F")]


def test_intersect_distinct_nulls_equal(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    got = sorted((r.k for r in intersect_distinct(a, b).collect()), key=lambda x: (x is None, x))
    assert got == [1, None]
    assert sorted(map(tuple, a.intersect(b).collect()), key=str) == sorted(
        map(tuple, intersect_distinct(a, b).collect()), key=str)


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([("a", 3, 1), ("b", None, 1), ("a", 4, 1), ("c", 5, 2)],
                               "s string, x int, g int")
    r = df.groupBy("g").agg(cond_count(F.col("s") == "a").alias("n"),
                            cond_sum(F.col("s") == "a", "x").alias("t")).orderBy("g").collect()
    assert [(x.n, x.t) for x in r] == [(2, 7), (0, 0)]


def test_filtered_left_join_keeps_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string")
    out = filtered_left_join(left, right, "k", F.col("t") == "x")
    assert sorted((r.k, r.t) for r in out.collect()) == [(1, "x"), (2, None), (3, None)]


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.integers(0, 10_000), min_size=0, max_size=60, unique=True),
       start=st.integers(1, 100))
def test_assign_keys_dense_unique_ordered(spark, keys, start):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [(r.key, r.k) for r in assign_keys(df, ["k"], start=start, partitions=3)
           .orderBy("key").collect()]
    assert [k for _, k in got] == sorted(keys)
    assert [key for key, _ in got] == list(range(start, start + len(keys)))


def test_assign_keys_with_repeated_order_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (0, "z")], "k int, t string")
    got = assign_keys(df, ["k"], start=80, partitions=2).orderBy("key").collect()
    assert [r.key for r in got] == [80, 81, 82, 83] and got[0].k == 0


def test_update_where_reads_old_values(spark):
    df = spark.createDataFrame([(1, 10, 100), (2, 20, 200)], "k int, a int, b int")
    out = update_where(df, {"a": F.col("b"), "b": F.col("a")}, F.col("k") == 1)
    assert sorted(map(tuple, out.collect())) == [(1, 100, 10), (2, 20, 200)]


def test_update_from_aggregate_null_sum_takes_else(spark):
    staff = spark.createDataFrame([(1, D("100.00")), (2, D("100.00")), (3, D("100.00"))],
                                  "k int, salary decimal(18,2)")
    agg = spark.createDataFrame([(1, D("5")), (2, None)], "fk int, s decimal(18,2)")
    factor = F.when(F.col("s") < 10, F.lit(D("1.10"))).otherwise(F.lit(D("1.15")))
    out = update_from_aggregate(staff, "k", agg, "fk", {"salary": F.round(F.col("salary") * factor)})
    got = {r.k: r.salary for r in out.collect()}
    assert got == {1: D("110.00"), 2: D("115.00"), 3: D("100.00")}
    assert out.count() == staff.count()


def test_keys_in_sequence_are_dealt_over_tasks(spark):
    """Sequential keys compress to a few bits: their bytes must not put them all into one task."""
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 400_000, 1, 2).union(spark.range(0, 400_000, 1, 2))
        got = duplicate_keys(df, "t", ["id"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in got) == 400_000
    assert max(r["count"] for r in got) <= 1.2 * (1 << 20) / 8 / 2, got      # each key is two rows of the shuffle


def test_audits_find_planted_violations(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(1, 1, "A"), (1, 9, "B"), (2, None, "Z"), (None, 9, None)],
                                  "id int, fk int, state string")
    dup = duplicate_keys(child, "child", ["id"]).collect()
    assert sorted((r.rule, r.key_value, r.n) for r in dup) == [("pk_duplicate", "1", 2),
                                                               ("pk_null", "NULL", 1)]
    twice = parent.union(parent)                    # a repeated parent key changes nothing
    for p in (parent, twice):
        orph = orphans(child, "child", "fk", p, "pk").collect()
        assert [(r.column_name, r.checked, r.n) for r in orph] == [("fk", 3, 2)]
    nulls = {r.column_name: r.n for r in null_counts(child, "child", ["id", "fk", "state"]).collect()}
    assert nulls == {"id": 1, "fk": 1, "state": 1}
    bad = check_rules(child, "child", ["id"], [("state_domain", "state",
                                                F.col("state").isin("A", "B"))]).collect()
    assert [(r.key_value, r.rule) for r in bad] == [("2", "state_domain")]


def test_assign_keys_splits_a_hot_order_value(spark):
    # a third of the rows share one order value: the row-hash tie-break must
    # spread them over several range partitions instead of one task
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, payload long")
    out = assign_keys(df, ["k"], start=1, partitions=6)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    keys = [r.key for r in out.select("key").collect()]
    assert sorted(keys) == list(range(1, 3001))


def test_assign_keys_dense_under_aqe_coalescing(spark):
    # enough rows and partitions that AQE coalesces shuffle partitions: the
    # partitioning must be frozen before counting, or offsets drift
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20011).alias("k")).distinct()
    out = assign_keys(df, ["k"], start=80, partitions=16)
    got = out.orderBy("key").select("key", "k").collect()
    ks = sorted(r.k for r in got)
    assert [r.key for r in got] == list(range(80, 80 + len(ks)))
    assert [r.k for r in got] == ks


def test_salted_join_exact_and_spread(spark):
    from quill.operators import salted_join
    # key 0 holds a third of the big side
    big = spark.createDataFrame([(0 if i % 3 == 0 else i % 50, i) for i in range(3000)],
                                "k int, v int")
    small = spark.createDataFrame([(k, f"t{k}") for k in range(0, 50, 2)] + [(0, "extra")],
                                  "k int, t string")
    plain = sorted(map(tuple, big.join(small, ["k"]).select("k", "v", "t").collect()))
    salted = salted_join(big, small, ["k"], ["v"], salts=8)
    assert sorted(map(tuple, salted.select("k", "v", "t").collect())) == plain
    left = salted_join(big, small, ["k"], ["v"], how="left", salts=8)
    assert left.count() == big.join(small, ["k"], "left").count()
    # the hot key's rows are spread over the salts
    spread = (big.filter(F.col("k") == 0).groupBy(F.pmod(F.xxhash64("v"), F.lit(8)).alias("s"))
              .count().collect())
    assert len(spread) == 8 and max(r["count"] for r in spread) < 250


@settings(max_examples=8, deadline=None)
@given(left=st.lists(st.integers(0, 20), max_size=30), right=st.lists(st.integers(0, 20), max_size=30))
def test_semi_join_never_adds_rows(spark, left, right):
    ldf = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, i int")
    rdf = spark.createDataFrame([(k,) for k in right], "k int")
    out = ldf.join(rdf, "k", "left_semi").collect()
    assert len(out) <= len(left)
    assert sorted(r.i for r in out) == sorted(i for i, k in enumerate(left) if k in set(right))


def test_band_join_shuffled_path_matches_broadcast(spark):
    bands = spark.createDataFrame([(0, 9, "a"), (10, 12, "b"), (13, 16, "c"), (16, 30, "d")],
                                  "lo int, hi int, tag string")
    vals = spark.createDataFrame([(v,) for v in range(-3, 35)], "v int")
    b = sorted(map(tuple, band_join(vals, F.col("v"), bands).collect()))
    s = band_join(vals, F.col("v"), bands, broadcast_rows=0)
    assert sorted(map(tuple, s.collect())) == b


def test_assign_keys_uses_the_sessions_partitions(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 37) % 3001).alias("k"))
    out = assign_keys(df, ["k"], start=1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n >= 4 and len(out.select(F.spark_partition_id()).distinct().collect()) == n
    got = out.orderBy("key").collect()
    assert [r.key for r in got] == list(range(1, 3001))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_registered_keys_run_on_several_partitions(spark, ctx):
    from quill.plans.basics import assign_order_keys
    out = assign_order_keys(ctx)
    assert len(out.select(F.spark_partition_id()).distinct().collect()) >= 4


def test_band_join_ignores_inverted_bands(spark):
    bands = spark.createDataFrame([(9, 0, "x"), (0, 9, "a")], "lo int, hi int, tag string")
    vals = spark.createDataFrame([(5,)], "v int")
    for limit in (200_000, 0):
        assert [r.tag for r in band_join(vals, F.col("v"), bands, broadcast_rows=limit).collect()] == ["a"]


def test_update_keeps_the_type_and_the_rows_it_does_not_touch(spark):
    """A rounded value must not round the rows beside it."""
    t = spark.createDataFrame([(1, D("10.47")), (2, D("20.55"))], "k int, s decimal(18,2)")
    whole = F.round(F.col("s") * 2, 0).cast("decimal(38,0)")
    got = update_where(t, {"s": whole}, F.col("k") == 1)
    assert sorted(map(tuple, got.collect())) == [(1, D("21.00")), (2, D("20.55"))] and got.schema["s"] == t.schema["s"]
    agg = spark.createDataFrame([(1, 5)], "key int, x int")
    got = update_from_aggregate(t, "k", agg, "key", {"s": whole})
    assert sorted(map(tuple, got.collect())) == [(1, D("21.00")), (2, D("20.55"))]
