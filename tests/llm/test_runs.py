import hashlib
import random
import zlib

import pytest

from quill.llm import runs
from quill.llm.queries import QUERIES


def _brute(w):
    """Every period, every start, extended word by word."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def _words(r, n):
    w = [str(r.randrange(r.choice([1, 2, 3, 10]))).encode() for _ in range(n)]
    if r.random() < 0.6 and n > 10:
        p, s = r.randrange(1, max(2, n // 4)), r.randrange(n)
        for i in range(s, n):
            w[i] = w[s + (i - s) % p]
    if r.random() < 0.4:        # a period whose blocks have a small period of their own
        unit = [b"0"] * r.randrange(1, 24) + [b"1"] * r.randrange(1, 3)
        w = w + unit * r.randrange(3, 8) + unit[:r.randrange(len(unit))]
    return w


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    r = random.Random(seed)
    n = 0
    for _ in range(120):
        docs = [(1, _words(r, r.randrange(0, 130))) for _ in range(r.randrange(1, 6))]
        if not any(w for _, w in docs):
            continue
        for (_, w), got in zip(docs, runs._group_runs(docs)):
            want = _brute(w)
            assert got == want, w
            n += len(want)
    assert n > 300


def test_nothing_matches_across_documents():
    w = b"a b a b a b".split()
    assert runs._group_runs([(1, w), (2, w), (3, w + w)]) == [[], [], [(0, 12, 2)]]


def test_smallest_period_and_first_period_stays():
    w = b"x a b a b a b a b a b y".split()
    found = runs._group_runs([(1, w)])[0]
    assert found == [(1, 10, 2)]
    assert runs.collapsed(w, found) == b"x a b y"
    assert runs.strongest([(0, 8, 2), (5, 12, 3), (3, 6, 1)]) == (3, 6, 1)
    assert runs.strongest([(4, 8, 2), (0, 12, 3)]) == (4, 8, 2)


def _expected(doc_id, text, plant):
    w = (text or "").encode().split()
    n = len(w)
    if plant and n and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _brute(w) if n < 3000 else runs._group_runs([(0, w)])[0]
    best = None
    for s, m, q in found:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in found)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def test_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_small).collect())
    assert got == sorted(_expected(i, t, True) for i, t in docs)
    assert sum(r[1] for r in got) > 10


def test_nasty_rows(spark, nasty):
    for plant in (False, True):
        got = sorted(map(tuple, runs.run_digests(nasty, repeat_tails=plant).collect()), key=str)
        assert got == sorted((_expected(r.doc_id, r.text, plant) for r in nasty.collect()), key=str)
    assert runs.run_digests(nasty.filter("false")).collect() == []


def test_collapse_gives_runs_and_text(spark):
    df = spark.createDataFrame([(1, "go go go go go go home"), (2, None), (3, "a b")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.text) for r in runs.collapse_runs(df).collect()}
    assert got == {1: ([(0, 6, 1)], "go home"), 2: ([], ""), 3: ([], "a b")}
