import numpy as np

from quill.llm.vectors import embedding_links, hadamard, keys_of


def brute(rows, threshold=0.9):
    ok = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            ok[i] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    ids = sorted(ok)
    m = np.stack([ok[i] for i in ids])
    link = m @ m.T >= threshold
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = {i: 0 for i, _ in rows}
    for a, b in zip(*np.nonzero(np.triu(link, 1))):
        x, y = find(ids[a]), find(ids[b])
        root[max(x, y)] = min(x, y)
        n[ids[a]] += 1
        n[ids[b]] += 1
    return {i: (n[i], find(i), find(i) == i) for i, _ in rows}


def vectors(seed, dim=64):
    r = np.random.default_rng(seed)
    out = []
    for noise in (0.0, 0.02, 0.1, 0.2, 0.25, 0.3, 0.35):          # cosines from 1 down to below 0.9
        for _ in range(6):
            base = r.normal(size=dim)
            out += [base + noise * r.normal(size=dim) for _ in range(8)]
    out += list(r.normal(size=(300, dim)))
    return [(int(i), [float(x) for x in np.float32(v)]) for i, v in zip(r.permutation(len(out)), out)]


def test_matches_brute_force(spark):
    rows = vectors(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in embedding_links(df).collect()}
    want = brute(rows)
    links = sum(v[0] for v in want.values())
    assert sum(v[0] for v in got.values()) >= 0.99 * links
    assert all(got[i][0] <= want[i][0] for i in want)              # none below the threshold
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert {r[0]: tuple(r[1:]) for r in embedding_links(df).collect()} == brute(rows)


def test_hashing():
    r = np.random.default_rng(2)
    x = r.normal(size=(50, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, probe = keys_of(x)
    again, _ = keys_of(x[::-1].copy())
    assert (home == again[::-1]).all() and home.shape == (50, 12) and probe.shape == (50, 72)


def test_recall_at_the_threshold():
    r = np.random.default_rng(3)
    n, dim = 2000, 64
    x = r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.normal(size=(n, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    (hx, px), (hy, py) = keys_of(x), keys_of(y)
    found = [bool(set(a) & set(b) or set(a) & set(q) or set(p) & set(b)) for a, p, b, q in zip(hx, px, hy, py)]
    assert np.mean(found) >= 0.97


def test_nasty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "x"), (2, [2.0, 0.0], "x"), (3, [1.0, 0.0], "x"), (4, None, "x"), (5, [], "x"),
            (6, [0.0, 0.0], "x"), (7, [nan, 1.0], "x"), (8, [inf, 1.0], "x"), (9, [None, 1.0], "x"),
            (10, [1.0, 0.0, 0.0], "x"), (None, [1.0, 0.0], "x"), (11, [1e200, 0.0], "x"), (12, [1e-200, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string")
    got = {r[0]: tuple(r[1:]) for r in embedding_links(df).collect()}
    for i in (1, 2, 3, 11, 12):
        assert got[i] == (4, 1, i == 1)
    for i in (4, 5, 6, 7, 8, 9, 10):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, True)
    assert embedding_links(df.limit(0)).collect() == []


def test_one_id_with_two_vectors(spark):
    r = np.random.default_rng(8)
    v0, v1 = r.normal(size=64), r.normal(size=64)
    rows = [(1, v0), (1, v1), (4, v0 + 0.01 * r.normal(size=64)), (5, v1 + 0.01 * r.normal(size=64)), (9, r.normal(size=64)),
            (9, v0)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embedding_links(df).collect()))
    # v0, its copy under 9 and its neighbour 4; v1 and its neighbour 5; a vector alone
    assert got == sorted([(1, 2, 1, True), (1, 1, 1, True), (4, 2, 1, False), (5, 1, 1, False), (9, 0, 9, True), (9, 2, 1, False)])
