import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quill.llm import search as S
from quill.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, k=10):
    docs = [(i, Counter(t)) for i, text in docs if (t := _terms(text))]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 100 - 75 + (75 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in _terms(text) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_terms_follow_the_pattern():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("aZ09 _-\x7f\x80é中\U0001f600@[`{/:\n") for _ in range(30))
        assert [t.decode() for t in S.terms(text)] == _terms(text)


def test_sketch_never_undercounts():
    r = random.Random(2)
    for size in (1, 2, 15, 16, 17, 400):
        counts = {f"t{r.random()}".encode(): r.choice([1, 2, 7, 255, 300]) for _ in range(size)}
        cells = np.frombuffer(S.sketch(counts), np.uint8)
        spots = S.coordinates(S.hashes(counts), len(cells))
        low = np.min([cells[at] for at in spots], axis=0)
        want = np.minimum(list(counts.values()), 255)
        assert (low >= want).all() and (low > want).mean() < 0.1
        other = S.coordinates(S.hashes([f"no{k}".encode() for k in range(2000)]), len(cells))
        assert (np.min([cells[at] for at in other], axis=0) > 0).mean() < 0.05


def _table(spark, seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(r.choices(vocabulary, weights, k=r.randrange(1, 40)))) for k in range(n)]
    docs += docs[:10] + [(None, "w50 w51"), (n, None), (n + 1, "!?"), (3, "w59 w58 other text of id 3")]
    docs += [(1000 + k, "w40 w41 w42") for k in range(30)]       # ties beyond the tenth place
    items = [(k, " ".join(r.choices(vocabulary, k=6))) for k in range(12)]
    items += [(50, None), (51, "nowhere"), (52, "w40 w41 w42"), (52, "w1 w1 w2"), (53, "")]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"WAVE": 2, "GROWTH": 2, "LEVELS": 8}, {"BLOCK_ITEMS": 5, "CELLS": 64},
                                      {"WIDTH": 1, "HASHES": 1, "MOST": 3}])
def test_equals_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(S, name, value)
    docs, items = _table(spark, 4, 300)
    got = S.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert _rows(got) == _brute(docs, items)


def test_long_counts_are_not_cut(spark):
    docs = [(1, "hot " * 900 + "x"), (2, "hot " * 400), (3, "hot cold"), (4, "cold " * 5)]
    items = [(1, "hot"), (2, "cold hot hot")]
    got = S.search(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert _rows(got) == _brute(docs, items)


def test_query_on_the_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()
    assert _rows(QUERIES["op12_max_sketch_search"](spark, sf_small)) == _brute(docs, items)


def test_nasty_rows(spark, nasty):
    items = spark.createDataFrame([(1, "a b 中文"), (2, None)], "item_id long, text string")
    want = _brute([(r.doc_id, r.text) for r in nasty.collect()], [(1, "a b 中文"), (2, None)])
    assert _rows(S.search(nasty, items)) == want and want
    assert S.search(nasty.filter("false"), items).collect() == []
    assert S.search(nasty, items.filter("false")).collect() == []
