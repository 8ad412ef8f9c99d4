import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quill.llm.lengths import length_table, quantile, suffix_sums, truncated_total
from quill.llm.packing import best_fit, cut, pack_documents
from quill.llm.tokens import Encoder


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_tokenizers(reference, spark, sf_small):
    enc = Encoder()
    r = random.Random(4)
    pool = list("ab Z09 \n\t\r\x0b'’‘“”—…€ßéñ \u0085 ​中文\U0001f600ǅⅧ²½_-") + \
        ["the ", "'s", "'LL", "  ", "\n\n", "<|endoftext|>", "www.", "123"]
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(4000)]
    texts += [chr(c) + "a " + chr(c) for c in range(0x250)]
    texts += [x["text"] for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    for t in texts:
        assert enc.ids(t) == reference.encode(t, add_special_tokens=False).ids, repr(t)
    assert enc.ids(None) == [] and enc.ids("") == []


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(5, 4) == [(0, 1), (1, 4)]
    assert cut(12, 4) == [(0, 4), (4, 4), (8, 4)]


def sequential(lengths, capacity):
    """Best-fit decreasing, one piece after the other."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, g in enumerate(room) if g >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(capacity - n)
    return Counter(room)


@pytest.mark.parametrize("seed", range(25))
def test_supersteps_equal_sequential_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 16, 31, 100])
    lengths = [min(capacity, 1 + int(r.expovariate(r.choice([3, 8]) / capacity))) for _ in range(r.randrange(1, 300))]
    counts = Counter(lengths)
    used, taken = Counter(), {n: [] for n in counts}
    places = []
    for n, rank, count, seq, off in best_fit(dict(counts), capacity):
        assert count > 0
        taken[n] += range(rank, rank + count)
        for s in range(seq, seq + count):
            used[s] += n
            places.append((s, off, n))
    assert all(sorted(v) == list(range(counts[n])) for n, v in taken.items())      # each piece once
    end = {}
    for s, off, n in sorted(places):                                               # gapless, within capacity
        assert off == end.get(s, 0)
        end[s] = off + n
    assert max(used.values()) <= capacity
    assert Counter(capacity - v for v in used.values()) == sequential(lengths, capacity)


def test_packed_table(spark, sf_small, reference):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = pack_documents(docs.repartition(3)).collect()
    ids = {r["doc_id"]: reference.encode(r["text"] or "", add_special_tokens=False).ids + [2]
           for r in docs.select("doc_id", "text").collect()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == ids.keys()
    for i, ps in pieces.items():
        ps.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in ps] == list(range(len(ps)))
        at = 0
        for p in ps:
            part = ids[i][at:at + p["length"]]
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids[i]) and all(p["length"] == 1024 for p in ps[1:])
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for seq in by.values():
        seq.sort()
        assert [o for o, _ in seq] == [sum(n for _, n in seq[:k]) for k in range(len(seq))]
        assert sum(n for _, n in seq) <= 1024
    total = sum(map(len, ids.values()))
    assert len(by) <= 1.02 * -(-total // 1024) + 1


def test_nasty(spark, nasty):
    rows = pack_documents(nasty).collect()
    one = {2: 1, 3: 1}
    by = Counter(r["doc_id"] for r in rows)
    assert all(by[k] == v for k, v in one.items()) and by[1] == 2 and by[None] == 2 and by[5] > 1
    assert all(r["length"] == 1 for r in rows if r["doc_id"] in (2, 3))
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert len(set(places)) == len(places)
    assert pack_documents(nasty.limit(0)).collect() == []


def test_length_table(spark, sf_small, reference, nasty):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("text").unionByName(nasty.select("text"))
    n = [len(reference.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    out = length_table(docs).cache()
    rows = {r["length"]: r for r in out.collect()}
    assert {k: r["docs"] for k, r in rows.items()} == Counter(n)
    for k, r in rows.items():
        assert r["tokens"] == k * r["docs"] and r["total_docs"] == len(n) and r["total_tokens"] == sum(n)
        assert r["docs_from"] == sum(x >= k for x in n) and r["tokens_from"] == sum(x for x in n if x >= k)
        assert r["tokens_truncated"] == sum(min(x, k) for x in n)
    for limit in (0, 1, 7, 100, 333, 1024, 10 ** 9):
        assert truncated_total(out, limit) == sum(min(x, limit) for x in n)
    for q in (0.0, 0.01, 0.25, 0.5, 0.9, 1.0):
        s = sorted(n)
        assert quantile(out, q) == next(x for x in s if sum(y <= x for y in s) >= q * len(s))


def test_suffix_sums_over_many_blocks(spark):
    r = random.Random(6)
    h = {r.randrange(60_000): 1 + r.randrange(9) for _ in range(500)}
    df = spark.createDataFrame(list(h.items()), "length long, n long").repartition(6)
    for x in suffix_sums(df).collect():
        assert x["docs_from"] == sum(v for k, v in h.items() if k >= x["length"])
        assert x["tokens_from"] == sum(k * v for k, v in h.items() if k >= x["length"])
    assert length_table(df.select(F.lit("x").alias("text")).limit(0)).collect() == []
