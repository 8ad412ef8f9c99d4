import itertools
import random

import numpy as np
import pyarrow as pa

from quill.llm import cluster
from quill.llm.lines import (MIN_CHARS, POSITIONS, WIDTH, all_shingles, canonical, char_shingles, cut_lines,
                             dedup_lines, signatures)
from quill.llm.neardup import Circulant

from llm_helpers import sentence


def brute(rows, share=0.8):
    """Cut lines per document, comparing every line with every other."""
    occ = [(i, k, canonical(x)) for i, t in rows if t for k, x in enumerate(t.split("\n"))
           if len(canonical(x)) >= MIN_CHARS]
    first = {}
    for i, k, x in sorted(occ):
        first.setdefault(x, (i, k))
    sets = {x: {x[j:j + WIDTH] for j in range(len(x) - WIDTH + 1)} for x in first}
    root = {x: x for x in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(first, 2):
        both = len(sets[x] & sets[y])
        if both >= share * (len(sets[x]) + len(sets[y]) - both):
            a, b = find(x), find(y)
            if first[a] > first[b]:
                a, b = b, a
            root[b] = a
    cut = {}
    for i, k, x in occ:
        if (i, k) != first[find(x)]:
            cut.setdefault(i, set()).add(k)
    return {i: (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut.get(i, ())),
                len(t.split("\n")) if t else 0, len(cut.get(i, ()))) for i, t in rows}


def rows():
    r = random.Random(8)
    pool = [sentence(r, 5 + r.randrange(12)) for _ in range(40)]
    out = []
    for i in range(60):
        lines = []
        for _ in range(r.randrange(1, 7)):
            x = r.choice(pool) if r.random() < 0.4 else sentence(r, 4 + r.randrange(12))
            if r.random() < 0.3:                       # one edit, another case, white space
                at = r.randrange(len(x))
                x = "  " + x[:at].upper() + "#" + x[at + 1:] + " "
            lines.append(x)
        out.append((i, "\n".join(lines + (["ok", ""] if i % 3 else []))))
    return out


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in dedup_lines(df).collect()}
    want = brute(data)
    # the links at the threshold itself may be missed: nearly all texts are equal
    assert sum(got[i] == want[i] for i in want) >= len(want) - 1
    assert sum(v[2] for v in got.values()) >= 0.98 * sum(v[2] for v in want.values())


def test_exact_repeats_go(spark):
    line = "every document carries this very line"
    df = spark.createDataFrame([(i, f"{line}\nown text of number {i * 7919} {'x' * i}\nshort") for i in range(50)],
                               "doc_id long, text string")
    got = {r["doc_id"]: r for r in dedup_lines(df).collect()}
    assert got[0]["text"].startswith(line) and got[0]["n_cut"] == 0
    assert all(line not in got[i]["text"] and got[i]["text"].endswith("short") for i in range(1, 50))


def test_nasty(spark, nasty):
    got = {}
    for r in dedup_lines(nasty).collect():
        got.setdefault(r["doc_id"], []).append((r["text"], r["n_lines"], r["n_cut"]))
    assert got[2] == [(None, 0, 0)] and got[3] == [("", 0, 0)] and got[4] == [(" \n\t ", 2, 0)]
    assert got[1] == [("a b c d e f g", 1, 0)] * 2 and len(got[None]) == 2
    assert got[5][0][2] == 0 and got[6][0][2] == 3000      # all lines of a near copy
    assert dedup_lines(nasty.limit(0)).collect() == []
    out = cut_lines(nasty)
    assert out.columns == [*nasty.columns, "n_lines", "n_cut"]
    assert {r["rest"] for r in out.collect()} == {"clash"}


def test_signature_of_joined_lines_equals_single():
    r = random.Random(1)
    lines = [canonical(sentence(r, 1 + r.randrange(30)) + "é中\U0001f600") for _ in range(200)]
    lines += ["y" * 50_000, sentence(r, 9000)]
    lines = [x for x in lines if len(x) >= WIDTH]
    circ = Circulant(32, 3, POSITIONS)
    got = signatures(lines, circ, WIDTH)
    assert all((got[k] == signatures([x], circ, WIDTH)[0]).all() for k, x in enumerate(lines))
    # coordinates agree as often as the sets overlap
    x, y = lines[0] * 3, (lines[0] * 3)[:-12] + "another end!"
    a, b = set(char_shingles(x).tolist()), set(char_shingles(y).tolist())
    many = Circulant(1000, 4, POSITIONS)
    same = (signatures([x], many, WIDTH) == signatures([y], many, WIDTH)).mean()
    assert abs(same - len(a & b) / len(a | b)) < 0.15
    assert np.array_equal(char_shingles("abc"), char_shingles("abc")) and len(char_shingles("abc")) == 1


def test_signature_is_the_minimum_over_all_windows():
    r = random.Random(8)
    lines = ["".join(r.choice("abcdéש ") for _ in range(n)) for n in (7, 8, 21, 22, 23, 38, 39, 40, 300, 40_000, 7)]
    circ = Circulant(32, 13, POSITIONS)
    got = signatures(lines, circ, WIDTH)
    for k, x in enumerate(lines):
        alone = [signatures([x[j:j + WIDTH]], circ, WIDTH)[0] for j in range(min(len(x), 400) - WIDTH + 1)]
        assert (got[k] == np.min(alone, axis=0)).all() if len(x) <= 400 else (got[k] <= np.min(alone, axis=0)).all()


def test_pairs_of_lines_are_compared_together():
    r = random.Random(9)

    def line(n):
        return "".join(r.choice("abcde é") for _ in range(n))

    rows = []
    for a in range(60):
        x = line(r.choice([7, 8, 20, 200, 300])) if a != 30 else line(200_000)
        for b in range(r.randrange(1, 9)):
            y = r.choice([x, x[:-1] + "z", x[:len(x) * 9 // 10] + "zz", x * 2, "z" * 7, line(200)])
            rows.append((a, 100 * a + b, x, y if len(y) >= WIDTH else x))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["a", "b", "ta", "tb"])
    batches = [batch, batch.slice(0, 1), batch.slice(0, 0)]
    calls = []

    def shingles(lines):
        calls.append(sum(len(x) for x in lines))
        return all_shingles(lines)

    def links(run):
        return [x for b in run(iter(batches)) for x in b.to_pylist()]

    for most in (len, None):
        want = links(cluster._pairs(char_shingles, 80, 100, most))
        assert {x["link"] for x in want} == {True, False}
        calls.clear()
        assert links(cluster._many_pairs(shingles, 80, 100, most)) == want
        # the long line's pairs apart, all others in a few calls; never more than a few long lines at once
        assert len(calls) < 50 and max(calls) < 3 * 200_000


def test_shingles_of_many_lines_are_those_of_each():
    for lines in (["abcdefg", "the same line", "日本語の行はここ", "x" * 50], ["abc", "the same line"]):
        got, size = all_shingles(lines)
        assert [np.unique(x).tolist() for x in np.split(got, np.cumsum(size)[:-1])] == [char_shingles(x).tolist() for x in lines]
