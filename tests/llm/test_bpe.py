import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quill.llm import bpe
from quill.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ab", "the in on er", "éèüß中文日本\U0001f600 　','", "   \n\t a1!",
             "'stremdlv ", "0123456789²", "!?.-_=*", "՘₏\U0001e6c0x  a", "<|endoftext|> "]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tokenizers.Tokenizer.from_file(vocabulary.file)


def _ids(parts):
    return np.frombuffer(b"".join(parts), "<u4").tolist()


def _plain(merges, text):
    """Merges in order of rank, each from left to right over the whole text."""
    tokens = list(text)
    for a, b in merges:
        out = []
        for t in tokens:
            if out and out[-1] == a and t == b:
                out[-1] = a + b
            else:
                out.append(t)
        tokens = out
    return tokens


def _closed(tokens, upto):
    ends = list(itertools.accumulate(map(len, tokens)))
    return [t for t, e in zip(tokens, ends) if e <= upto]


@pytest.mark.parametrize("seed", range(25))
def test_lookahead_is_sufficient(seed):
    r = random.Random(seed)
    parts, merges = ["a", "b"], []
    for _ in range(r.randrange(1, 7)):
        pair = (r.choice(parts), r.choice(parts))
        if pair[0] + pair[1] not in parts and len(pair[0] + pair[1]) < 7:
            merges.append(pair)
            parts.append(pair[0] + pair[1])
    far = bpe.lookahead(merges)
    for n in range(far + 1, far + 6):
        for _ in range(30):
            head = "".join(r.choice("ab") for _ in range(n))
            known = _closed(_plain(merges, head), n - far)
            for _ in range(6):
                whole = _plain(merges, head + "".join(r.choice("ab") for _ in range(r.randrange(12))))
                assert _closed(whole, n - far) == known


def test_improper_list_is_refused():
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")])


def test_equals_the_library_in_chunks_of_any_size(monkeypatch, vocabulary, library):
    r = random.Random(7)
    encoder = bpe.Encoder(vocabulary)
    for _ in range(800):
        a = r.choice(ALPHABETS)
        text = "".join(r.choice(a) for _ in range(r.choice([0, 1, 3, 50, 400])))
        if r.random() < 0.3:
            text += "<|endoftext|>" + "".join(r.choice(r.choice(ALPHABETS)) for _ in range(40))
        monkeypatch.setattr(bpe, "CHUNK", r.choice([1 << 16, 8, 64, 300]))
        got = _ids(encoder.encode(text[k:k + bpe.CHUNK] for k in range(0, len(text), bpe.CHUNK)))
        assert got == library.encode(text, add_special_tokens=False).ids, text
        decoder = bpe.Decoder(vocabulary.bytes)
        pieces = [decoder.feed([i]) for i in got] + [decoder.feed([], last=True)]
        assert "".join(pieces) == library.decode(got, skip_special_tokens=False) == text


def test_long_pre_tokens_stream_through_a_bounded_window(monkeypatch, vocabulary, library):
    monkeypatch.setattr(bpe, "WINDOW", 2)
    monkeypatch.setattr(bpe, "CHUNK", 1000)
    r = random.Random(8)
    held = []
    ids = bpe.Vocabulary.ids
    monkeypatch.setattr(bpe.Vocabulary, "ids", lambda self, raw: held.append(len(raw)) or ids(self, raw))
    encoder = bpe.Encoder(vocabulary)
    for k in range(12):
        text = ("".join(r.choice(["a", "th", "he", "in", "tion"]) for _ in range(6000)) if k % 2
                else " " * (3000 + 700 * k) + "x" * (k % 3))
        assert _ids(encoder.text(text)) == library.encode(text, add_special_tokens=False).ids
    assert max(held) <= 4 * vocabulary.far      # what is fed at once, and what is held back


def test_broken_bytes_decode_like_the_library(vocabulary, library):
    r = random.Random(9)
    for _ in range(300):
        ids = [r.choice([vocabulary.first[r.randrange(256)], r.randrange(50257)]) for _ in range(r.randrange(1, 12))]
        assert bpe.Decoder(vocabulary.bytes).feed(ids, last=True) == library.decode(ids, skip_special_tokens=False)


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_query_equals_the_library(spark, sf_small, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bpe_round_trip"](spark, sf_small).collect()}
    assert got == {i: _expected(library, t) for i, t in docs.items()}


def test_nasty_rows(spark, nasty, library):
    got = sorted((tuple(r) for r in bpe.round_trip(nasty).collect()), key=str)
    want = sorted(((r.doc_id, *_expected(library, r.text)) for r in nasty.collect()), key=str)
    assert got == want
    assert bpe.round_trip(nasty.filter("false")).collect() == []


def test_parts_decode_to_the_texts(spark, nasty):
    docs = nasty.filter("doc_id is not null").dropDuplicates(["doc_id"])
    tokens = bpe.encode(docs, part_ids=1000)
    assert tokens.select(F.max(F.size("ids"))).first()[0] <= 1000
    parts = bpe.decode(tokens.repartition(7)).collect()
    for row in docs.collect():
        own = sorted((p.part, p.text) for p in parts if p.doc_id == row.doc_id)
        assert "".join(t for _, t in own) == (row.text or "")
