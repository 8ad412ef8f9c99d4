"""Interval joins and audits against nested loops."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from quill.operators import band_audit, interval_audit, interval_join
from quill.operators.intervals import interval_nodes, value_nodes
from quill.plans import intervals as P

D = decimal.Decimal


@pytest.mark.parametrize("bits,levels", [(1, 9), (2, 5), (3, 3)])
def test_nodes_cover_an_interval_once(spark, bits, levels):
    r = random.Random(bits)
    top = 1 << (bits * levels)
    pairs = [(0, 0), (0, top - 1), (1, top - 2), (top - 1, top - 1), (5, 4)]
    pairs += [tuple(sorted((r.randrange(top), r.randrange(top)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for a, b, nodes in df.select("a", "b", interval_nodes(F.col("a"), F.col("b"), levels, bits)).collect():
        assert len(nodes) <= 2 * ((1 << bits) - 1) * levels + 1        # bits = 1: at most 2 log n rows
        held = []
        for node in nodes:
            k = next(k for k in range(levels + 1) if 1 << (bits * (levels - k)) <= node)
            index = node - (1 << (bits * (levels - k)))
            held += range(index << (bits * k), (index + 1) << (bits * k))
        assert sorted(held) == list(range(a, b + 1))
    above = spark.range(top).select(value_nodes(F.col("id"), levels, levels, bits).alias("n"))
    assert above.filter(F.size("n") != levels + 1).count() == 0


def _inside(v, lo, hi):
    return v is not None and (lo is None or v >= lo) and (hi is None or v <= hi)


@pytest.mark.parametrize("bits", [1, 2, 4])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_nested_loops(spark, bits, how):
    r = random.Random(10 * bits)
    values = [(i, r.choice("abc"), r.choice([None, *range(-40, 400)])) for i in range(150)]
    bands = [(r.choice("abcd"), lo, lo + r.choice([0, 1, 7, 60, 300]), i)
             for i, lo in enumerate(r.randrange(-20, 300) for _ in range(60))]
    bands += [("a", None, 10, 100), ("b", 50, None, 101), ("a", None, None, 102), ("a", 9, 3, 103), ("a", 5, 5, 104),
              ("a", 5, 5, 104)]
    vdf = spark.createDataFrame(values, "id int, k string, v int")
    bdf = spark.createDataFrame(bands, "k string, lo int, hi int, tag int")
    want = []
    for i, k, v in values:
        own = [t for bk, lo, hi, t in bands if bk == k and _inside(v, lo, hi) and (None in (lo, hi) or lo <= hi)]
        want += [(i, t) for t in own] or ([(i, None)] if how == "left" else [])
    got = interval_join(vdf, F.col("v"), bdf, on=["k"], how=how, bits=bits)
    assert got.columns == ["id", "k", "v", "lo", "hi", "tag"]
    assert sorted(((x.id, x.tag) for x in got.collect()), key=str) == sorted(want, key=str)


def test_join_without_key_dates_and_decimals(spark):
    day = dt.date(2000, 1, 1)
    bands = [(day, day + dt.timedelta(99), "wide"), (day + dt.timedelta(1), day + dt.timedelta(2), "in"),
             (day + dt.timedelta(50), None, "open")]
    vals = [(day + dt.timedelta(k),) for k in (-1, 0, 1, 2, 3, 50, 99, 100, 5000)]
    got = interval_join(spark.createDataFrame(vals, "d date"), F.col("d"),
                        spark.createDataFrame(bands, "lo date, hi date, tag string"))
    assert sorted(((x.d - day).days, x.tag) for x in got.collect()) == sorted(
        ((v - day).days, t) for v, in vals for lo, hi, t in bands if _inside(v, lo, hi))
    bands = spark.createDataFrame([(D("1.00"), D("1.99"), 1), (D("2.00"), D("2.99"), 2)],
                                  "lo decimal(18,2), hi decimal(18,2), tag int")
    vals = spark.createDataFrame([(D(x),) for x in ("1.000", "1.990", "1.995", "2.000", "0.999", "2.990")], "v decimal(18,3)")
    assert sorted((str(x.v), x.tag) for x in interval_join(vals, F.col("v"), bands).collect()) == [
        ("1.000", 1), ("1.990", 1), ("2.000", 2), ("2.990", 2)]
    none = interval_join(vals, F.col("v"), bands.filter("false"), how="left").collect()
    assert len(none) == 6 and all(x.tag is None for x in none)


def test_wide_bands_do_not_blow_up(spark):
    """A million-wide band side: rows of the exchange stay below 2 log n per band."""
    bands = spark.range(500).select((F.col("id") * 7).alias("lo"), (F.col("id") * 7 + 1_000_000).alias("hi"))
    n = bands.select(F.size(interval_nodes(F.col("lo"), F.col("hi"), 20)).alias("n")).agg(F.max("n")).first()[0]
    assert n <= 40
    vals = spark.range(0, 1_000_000, 50_000).select(F.col("id").alias("v"))
    got = interval_join(vals, F.col("v"), bands)
    assert got.count() == sum(1 for v in range(0, 1_000_000, 50_000) for k in range(500) if 7 * k <= v)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_node_rows_are_broadcast_by_their_own_number(spark):
    """A planner sees 20,000 small intervals; the join gets up to 41 nodes of each."""
    vals = spark.range(0, 1_000_000, 50_000).select(F.col("id").alias("v"))
    for n, kind in ((20, "BroadcastHashJoin"), (20_000, "SortMergeJoin")):
        bands = spark.range(n).select((F.col("id") * 7).alias("lo"), (F.col("id") * 7 + 1_000_000).alias("hi"))
        got = interval_join(vals, F.col("v"), bands)
        assert kind in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == sum(min(v // 7 + 1, n) for v in range(0, 1_000_000, 50_000))


def _audit(bands, step):
    out, groups = [], {}
    for k, lo, hi in bands:
        if lo is None or hi is None or lo <= hi:
            groups.setdefault(k, {}).setdefault((lo, hi), []).append(1)
    low, high = float("-inf"), float("inf")
    for k, own in groups.items():
        top = None
        for lo, hi in sorted(own, key=lambda x: (low if x[0] is None else x[0], high if x[1] is None else x[1])):
            n = len(own[lo, hi])
            a, b = low if lo is None else lo, high if hi is None else hi
            issue = None
            if n > 1 or (top is not None and a <= top):
                issue = "overlap"
            elif top is not None and a > top + step:
                issue = "gap"
            if issue:
                before = hi if top is None else None if top == high else top
                out.append((k, lo, hi, n, before, issue))
            top = b if top is None else max(top, b)
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_audit_equals_brute_force(spark, partitions):
    r = random.Random(partitions)
    bands = [("hot", lo, lo + r.randrange(-1, 9)) for lo in (r.randrange(2000) for _ in range(300))]
    bands += [(f"k{r.randrange(20)}", lo, lo + r.randrange(40)) for lo in (r.randrange(300) for _ in range(120))]
    bands += [("hot", 2, 900), ("o", 1, 5), ("o", 3, None), ("o", 900, 901), ("p", None, 4), ("p", None, 9), ("p", 10, 11),
              (None, 1, 2), (None, 5, 6), ("twice", 1, 2), ("twice", 1, 2)]
    df = spark.createDataFrame(bands, "k string, lo int, hi int").repartition(3)
    got = interval_audit(df, on=["k"], step=1, partitions=partitions)
    assert sorted(map(tuple, got.collect()), key=str) == _audit(bands, 1)


def test_band_audit_sees_beyond_neighbours(spark):
    bands = spark.createDataFrame([(0, 100), (1, 2), (50, 60), (200, 300)], "lo int, hi int")
    assert sorted((x.lo, x.prev_hi, x.issue) for x in band_audit(bands, step=1).collect()) == [
        (1, 100, "overlap"), (50, 100, "overlap"), (200, 100, "gap")]


def test_reports_plan_no_nested_loop_and_no_global_window(ctx):
    join = P.interval_join_status(ctx)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in join and "Cartesian" not in join
    audit = interval_audit(P.price_spans(ctx), step=D("0.01"), partitions=5)
    text = audit._jdf.queryExecution().executedPlan().toString()
    # without a key, one window has one row per range partition to order; no other is global
    assert "NestedLoop" not in text and text.count("SinglePartition") == 1
    keyed = P.interval_audit_deliveries(ctx)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in keyed
