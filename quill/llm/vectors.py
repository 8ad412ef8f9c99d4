"""Embedding links by cross-polytope hashing.

1. equal vectors form a class, represented by the smallest id;
2. every representative is rotated pseudo-randomly (three rounds of random
   signs and fast Hadamard transform) and hashed to the closest vertex of the
   cross-polytope, ``HASHES`` times per table; multiprobe adds the keys in
   which one or two hashes take their second vertex;
3. inside a bucket, vectors are compared with the bucket's smallest id only.
   What lies within half of the link angle of a centre forms a tight class:
   the angle is a metric, so all of its members are linked with each other and
   are counted without ever being paired;
4. classes that meet in a home bucket or by a probe are compared by their
   centres; class pairs too far apart for any link (again by the metric) go,
   of the others the members are compared, and every link is confirmed by its
   cosine in double precision;
5. links are counted with multiplicities, components taken over class stars
   and confirmed links.

No bucket is capped. 12 tables of 3 hashes and 6 probes each: the tests measure
the recall of pairs at cosine 0.9 on keys and on whole results.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep, sized
from quill.llm.graph import components
from quill.llm.texts import mix

THRESHOLD = 0.9
TABLES, HASHES, SEED = 12, 3, 5
_MARGIN = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (orthonormal)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / math.sqrt(d)


def keys_of(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES,
            seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Home keys ``(n, tables)`` and probe keys ``(n, tables * probes)`` of unit rows."""
    n, dim = x.shape
    size = 1 << max(dim - 1, 1).bit_length()
    x = np.pad(x, ((0, 0), (0, size - dim)))
    rng = np.random.default_rng([seed, dim])
    home, probe = [], []
    for t in range(tables):
        best = []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), size))
            at = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            v = np.take_along_axis(y, at, axis=1)
            swap = np.abs(v[:, 0]) < np.abs(v[:, 1])
            at[swap], v[swap] = at[swap][:, ::-1], v[swap][:, ::-1]
            best.append(2 * at + (v < 0))                       # vertices: first, second

        def key(second: tuple[int, ...]) -> np.ndarray:
            out = np.full(n, (t + 1) * 1_000_003 + dim, np.uint64)
            for j in range(hashes):
                out = mix(out + best[j][:, int(j in second)].astype(np.uint64))
            return out.view(np.int64)

        home.append(key(()))
        probe += [key((j,)) for j in range(hashes)]
        probe += [key((i, j)) for i in range(hashes) for j in range(i)]
    return np.stack(home, axis=1), np.stack(probe, axis=1)


def _hashed(tables: int, hashes: int, seed: int):
    def run(batches):
        for b in batches:
            rows = [None if v is None or not len(v) or None in v else np.array(v, np.float64)
                    for v in b.column(1).to_pylist()]
            unit: list = [None] * len(rows)
            for k, v in enumerate(rows):
                if v is not None and np.isfinite(v).all() and v.any():
                    v = v / np.abs(v).max()          # the square of a component can't overflow
                    unit[k] = v / math.sqrt(float(v @ v))
            fp = [None if u is None else hashlib.blake2b(rows[k].tobytes(), digest_size=16).digest()
                  for k, u in enumerate(unit)]
            home: list = [None] * len(rows)
            probe: list = [None] * len(rows)
            for dim in {len(u) for u in unit if u is not None}:
                at = [k for k, u in enumerate(unit) if u is not None and len(u) == dim]
                h, p = keys_of(np.stack([unit[k] for k in at]), tables, hashes, seed)
                for k, hk, pk in zip(at, h, p):
                    home[k], probe[k] = hk, pk
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fp, pa.binary()), pa.array(unit, pa.list_(pa.float64())),
                 pa.array(home, pa.list_(pa.int64())), pa.array(probe, pa.list_(pa.int64()))],
                ["id", "fp", "unit", "home", "probe"])
    return run


def _cosines(batches):
    for b in batches:
        cos = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            cos.append(float(x @ y) if len(x) == len(y) else -1.0)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cos, pa.float64())],
                                         ["a", "b", "cos"])


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, tables: int = TABLES, hashes: int = HASHES,
                    seed: int = SEED) -> DataFrame:
    """One row per input row: ``(vec_id, n_links, component_id, kept)``.

    Vectors that are null, empty, zero or hold null or non-finite components
    are linked with nothing, as are vectors of different length with each
    other and rows with a null id (component null, kept). Rows that repeat an
    id and vector count as further vectors of that id; rows of one id with
    other vectors are vectors of their own, linked only where their cosine says
    so, each with its own links and component. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    angle = math.acos(threshold)
    items = keep(arrow(vectors.select(F.col(id_col).cast("long").alias("id"),
                                      F.col(vec_col).cast("array<double>").alias("v")),
                       _hashed(tables, hashes, seed),
                       "id long, fp binary, unit array<double>, home array<long>, probe array<long>"))
    valid = items.filter("fp is not null and id is not null")
    # a class has a number of its own: one id may have several vectors
    same = keep(valid.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
                .select("fp", "rep", "m", F.monotonically_increasing_id().alias("node")))
    reps = keep(valid.join(same.select("fp", F.col("rep").alias("id"), "m", "node"), ["fp", "id"])
                .dropDuplicates(["fp"]).select(F.col("node").alias("id"), "m", "unit", "home", "probe"))
    units = reps.select("id", "unit")

    def cosines(pairs: DataFrame) -> DataFrame:
        ua = units.select(F.col("id").alias("a"), F.col("unit").alias("ua"))
        ub = units.select(F.col("id").alias("b"), F.col("unit").alias("ub"))
        both = pairs.join(ua, "a").join(ub, "b").select("a", "b", "ua", "ub")
        return keep(arrow(both, _cosines, "a long, b long, cos double"))

    # tight classes around the smallest id of a bucket
    home = reps.select("id", F.explode("home").alias("key"))
    hot = keep(home.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("top"))
               .filter("centre < top").select("key", "centre"))
    star = cosines(home.join(sized(hot), "key").filter("id <> centre")
                   .select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    tight = keep(star.filter(F.col("cos") >= math.cos(angle / 2 - _MARGIN)))
    follower = keep(tight.select(F.col("b").alias("a")).distinct())
    near = keep(tight.join(follower, "a", "left_anti")
                .groupBy(F.col("b").alias("id")).agg(F.min(F.struct("a", "cos")).alias("c"))
                .select("id", F.col("c.a").alias("centre"), F.acos(F.least("c.cos", F.lit(1.0))).alias("r")))
    member = keep(reps.select("id", "m").join(near, "id", "left")
                  .select("id", "m", F.coalesce("centre", "id").alias("centre"),
                          F.coalesce("r", F.lit(0.0)).alias("r")))
    classes = keep(member.groupBy("centre").agg(F.sum("m").alias("w"), F.count(F.lit(1)).alias("size"),
                                                F.max("r").alias("radius")))

    # classes that meet: home with home, and probe with home
    of = member.select("id", "centre")
    at_home = (home.join(of, "id").select("key", "centre").distinct())
    at_probe = (reps.select("id", F.explode("probe").alias("key")).join(of, "id")
                .select("key", F.col("centre").alias("other")).distinct())
    meet = at_home.join(at_home.withColumnRenamed("centre", "other"), "key").unionByName(
        at_home.join(at_probe, "key")).filter("centre <> other")
    meet = cosines(meet.select(F.least("centre", "other").alias("a"), F.greatest("centre", "other").alias("b"))
                   .distinct())
    size = classes.select("centre", "size", "radius")
    meet = (meet.join(size.select(F.col("centre").alias("a"), F.col("size").alias("sa"),
                                  F.col("radius").alias("ra")), "a")
            .join(size.select(F.col("centre").alias("b"), F.col("size").alias("sb"),
                              F.col("radius").alias("rb")), "b")
            .withColumn("phi", F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0))))
            .filter(F.col("phi") <= F.col("ra") + F.col("rb") + (angle + _MARGIN)))
    meet = keep(meet.select("a", "b", "cos", "phi", (F.col("sa") + F.col("sb") > 2).alias("large")))
    ma = member.select(F.col("centre").alias("a"), F.col("id").alias("x"), F.col("r").alias("rx"))
    mb = member.select(F.col("centre").alias("b"), F.col("id").alias("y"), F.col("r").alias("ry"))
    wide = (meet.filter("large").select("a", "b", "phi").join(ma, "a").join(mb, "b")
            .filter(F.col("phi") <= F.col("rx") + F.col("ry") + (angle + _MARGIN))
            .select(F.col("x").alias("a"), F.col("y").alias("b")))
    links = keep(meet.filter("not large").select("a", "b", "cos").unionByName(cosines(wide))
                 .filter(F.col("cos") >= threshold).select("a", "b"))

    weight = member.select(F.col("id").alias("b"), "m")
    outer = (links.union(links.select("b", "a")).join(weight, "b")
             .groupBy(F.col("a").alias("id")).agg(F.sum("m").alias("outer")))
    comp = keep(components(member.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
                           .unionByName(links)))
    result = keep(member.join(classes.select("centre", "w"), "centre").join(outer, "id", "left")
                  .join(comp.withColumnRenamed("node", "id"), "id", "left")
                  .select(F.col("id").alias("node"), (F.col("w") - 1 + F.coalesce("outer", F.lit(0))).alias("n"),
                          F.coalesce("comp", "id").alias("comp")))
    low = (result.join(same.select("node", "rep"), "node").groupBy("comp").agg(F.min("rep").alias("low")))
    named = keep(result.join(low, "comp").select("node", "n", "low"))
    node_of = items.select("id", F.when(F.col("id").isNotNull(), F.col("fp")).alias("fp")).join(
        same.select("fp", "node"), "fp", "left")
    return (node_of.join(named, "node", "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("low", "id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
