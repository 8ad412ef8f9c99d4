import itertools
import random

import numpy as np

from quill.llm.cluster import _blocks
from quill.llm.graph import components
from quill.llm.neardup import Circulant, keep_one, near_duplicates
from quill.llm.texts import overlap, word_shingles

from llm_helpers import sentence


def brute(rows):
    sets = {}
    for i, t in rows:
        w = t.encode().lower().split() if t else []
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def near_rows(seed, groups=6):
    """Groups around a base text: copies, near copies at all distances, chains."""
    r = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = sentence(r, 60 + 30 * g).split()
        for k in range(25):
            w = list(base)
            for _ in range(k // 3):
                w[r.randrange(len(w))] = "edit" + str(r.randrange(1000))
            rows.append((i, " ".join(w).upper() if k == 4 else " ".join(w)))
            i += 1
            base = w if k % 5 == 4 else base
    rows += [(i, ""), (i + 1, None), (i + 2, "one two"), (i + 3, "One  two"), (i + 4, "one two three")]
    r.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = near_rows(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(df).collect()}
    assert got == brute(rows)


def test_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(df).collect()}
    assert got == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_nasty(spark, nasty):
    got = sorted(map(tuple, near_duplicates(nasty).collect()), key=str)
    assert len(got) == nasty.count()
    by = {}
    for doc, n, comp, kept in got:
        by.setdefault(doc, []).append((n, comp, kept))
    assert by[1] == [(3, 1, True)] * 2                    # a repeated row: the same document
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert sorted(by[None], key=str) == [(0, None, True), (3, None, True)]
    assert by[6][0][1] == 5 and not by[6][0][2]           # very long near copies
    assert near_duplicates(nasty.limit(0)).collect() == []
    one = keep_one(nasty)
    assert one.columns == nasty.columns
    assert sorted((r["doc_id"] for r in one.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, None, None], key=str)


def test_components(spark):
    r = random.Random(2)
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 101 + k) for k in range(60)]
    loose = [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(120)]
    edges = chain + star + loose + [(7, 7), (9, 8)]
    r.shuffle(edges)
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: find(x) for x in root if x in {y for a, b in edges if a != b for y in (a, b)}}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_circulant_signature_estimates_jaccard():
    circ = Circulant(400)
    r = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        both = r.integers(0, 2 ** 63, int(1000 * share)).astype(np.uint64)
        x = np.concatenate([both, r.integers(0, 2 ** 63, 1000 - len(both)).astype(np.uint64)])
        y = np.concatenate([both, r.integers(0, 2 ** 63, 1000 - len(both)).astype(np.uint64)])
        jac = len(both) / (2000 - len(both))
        assert abs((circ.signature(x) == circ.signature(y)).mean() - jac) < 0.1
    # a shift of the second permutation, seen from the shingle's place
    s = circ.signature(both[:1])
    assert (s == circ.shifts[circ.places(both[:1])][0]).all()


def test_blocks_connect_what_pairs_connect():
    import pyarrow as pa
    rows = [(i, t) for i, t in near_rows(4, groups=3) if t]
    left, right = rows[:30], rows[20:]
    want = set()
    for (i, s), (j, t) in itertools.product(left, right):
        x, y = word_shingles(s), word_shingles(t)
        both = overlap(x, y)
        if i != j and both * 100 >= 75 * (len(x) + len(y) - both):
            want.add((min(i, j), max(i, j)))

    def got(single, label):
        rows = [[{"id": i, "label": label(i), "text": t} for i, t in side] for side in (left, right)]
        batch = pa.RecordBatch.from_pylist([{"single": single, "left": rows[0], "right": rows[1]}])
        return [p for b in _blocks(word_shingles, 75, 100)([batch])
                for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if p[0] != p[1]]

    def parts(edges):
        root = {i: i for i, _ in rows}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        return {frozenset(i for i in root if find(i) == r) for r in {find(i) for i in root}}

    forest = got(True, lambda i: i)
    assert set(forest) <= want and parts(forest) == parts(want) and len(forest) < len(rows)
    inside = {i for p in want for i in p} & {i for i, _ in left}
    assert {a for p in got(False, lambda i: i) for a in p} >= {i for i in inside if i not in dict(right)}
    assert len(got(False, lambda i: -1)) <= 1


def test_bucket_of_single_items_is_compared_in_blocks(spark, monkeypatch):
    """A bucket whose centre is like nobody, with pairs that are alike: no pair of
    items is a row, and none is lost."""
    from quill.llm import cluster

    r = random.Random(12)
    passage = sentence(r, 30)
    texts = [(k, passage + " " + sentence(r, 30)) for k in range(300)]
    for k in range(0, 40, 2):                  # 20 pairs, spread over blocks
        a, b = 20 + k, 290 - 5 * k
        texts[b] = (b, texts[a][1] + " tail")
    df = spark.createDataFrame(texts, "id long, text string")
    keys = [(1, k, 0) for k, _ in texts] + [(2, k, 0) for k, _ in texts] + [(3, 10, 10), (3, 11, 10)]
    bucket = spark.createDataFrame(keys, "key long, id long, centre long")
    seen = []
    arrow = cluster.arrow
    monkeypatch.setattr(cluster, "arrow", lambda rows, fn, schema: seen.append((rows, schema)) or arrow(rows, fn, schema))
    monkeypatch.setattr(cluster, "BLOCK", 64)
    low = {x.id: x.low for x in cluster.clusters(bucket, df, word_shingles, 75, 100).collect()}
    want = {}
    for k in range(0, 40, 2):
        a, b = sorted((20 + k, 290 - 5 * k))
        want[b] = a
    assert low == want
    blocks = [rows.count() for rows, schema in seen if schema == "a long, b long"]
    assert blocks == [15]                      # 5 blocks of one of the two equal buckets: 5 * 6 / 2
    monkeypatch.setattr(cluster, "BLOCK_BYTES", 4000)
    again = {x.id: x.low for x in cluster.clusters(bucket, df, word_shingles, 75, 100).collect()}
    assert again == want


def test_bucket_of_many_components(spark, monkeypatch):
    """Forty components and a larger one meet in one bucket: no join pairs them row
    by row, and a link between any two of them is found."""
    from quill.llm import cluster

    r = random.Random(17)
    texts, keys = [], []
    for c in range(40):
        base = sentence(r, 60)
        own = list(range(3 * c, 3 * c + (3 if c == 20 else 2)))
        texts += [(i, f"{base} {i}") for i in own]
        keys += [(100 + c, i, own[0]) for i in own]
    body = dict(texts)
    for a, b in ((3, 70), (30, 62), (45, 6)):       # links across components, one to the large one
        w = body[a].split()
        body[b], body[b + (1 if b % 3 == 0 else -1)] = " ".join(w[:-4] + ["far", str(b)]), body[b + (1 if b % 3 == 0 else -1)]
    keys += [(1, i, 0) for i in body]
    df = spark.createDataFrame(list(body.items()), "id long, text string")
    bucket = spark.createDataFrame(keys, "key long, id long, centre long")
    kept = []
    keep = cluster.keep
    monkeypatch.setattr(cluster, "keep", lambda rows, **o: kept.append(keep(rows, **o)) or kept[-1])
    low = {x.id: x.low for x in cluster.clusters(bucket, df, word_shingles, 75, 100).collect()}
    edges = spark.createDataFrame(
        [(a, b) for (a, s), (b, t) in itertools.combinations(sorted(body.items()), 2)
         for x, y in [(word_shingles(s), word_shingles(t))]
         if 100 * overlap(x, y) >= 75 * (len(x) + len(y) - overlap(x, y))], "a long, b long")
    assert low == {x.node: x.comp for x in components(edges).collect() if x.node != x.comp}
    assert max(k.count() for k in kept) <= len(keys)
