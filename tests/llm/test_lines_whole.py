"""Line dedup as registered: lines of every length take part."""
import itertools
import random

from quill.llm.lines import WIDTH, canonical
from quill.llm.queries import op6_line_dedup

from corpus_pipeline import line_dedup
from llm_helpers import sentence


def brute(rows, share=0.8):
    occ = [(i, k, x) for i, t in rows for k, line in enumerate(t.split("\n")) if (x := canonical(line))]
    first = {}
    for i, k, x in sorted(occ):
        first.setdefault(x, (i, k))
    # a line shorter than a shingle is one shingle
    sets = {x: {x[j:j + WIDTH] for j in range(max(len(x) - WIDTH, 0) + 1)} for x in first}
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
    cut = {(i, k) for i, k, x in occ if (i, k) != first[find(x)]}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in cut) for i, t in rows}


def documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_short_lines_match_brute_force(spark, tmp_path):
    r = random.Random(3)
    words = ["les.", "and ornd.", "wh the.", "nt onor. the of it.", "今日は", "x", "abcdefg"]
    rows = [(i, "\n".join(
        [r.choice((str.upper, str.lower, " {} ".format))(r.choice(words)) for _ in range(r.randrange(1, 5))]
        + [sentence(r, 8), "", f"{i}"])) for i in range(60)]
    got = {x["doc_id"]: x["text"] for x in op6_line_dedup(spark, documents(spark, tmp_path, rows)).collect()}
    assert got == brute(rows)


def test_near_copies_of_short_lines(spark, tmp_path):
    rows = [(1, "short line of text\nabc"), (2, "short line of texts\nabcd"), (3, "short line of text!")]
    sf = documents(spark, tmp_path, rows)
    assert {x["doc_id"]: x["text"] for x in op6_line_dedup(spark, sf).collect()} == brute(rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert {x["doc_id"]: x["text"] for x in line_dedup(spark, docs, sf).collect()} == {1: rows[0][1], 2: "abcd"}


def test_one_id_with_two_texts(spark, tmp_path):
    line, other = "a line that two documents carry", "text that stands here and nowhere else"
    rows = [(1, f"{line}\nfirst of its kind"), (2, f"{other}\nxyz\n{line}\nlast line of the long one"),
            (2, f"short {other[::-1]}"), (2, f"{line}\nmiddle {line[::-1]}"), (2, f"{line}\nmiddle {line[::-1]}"),
            (3, f"head of the third\n{line}s")]
    got = sorted((x["doc_id"], x["text"], x["n_cut"]) for x in
                 op6_line_dedup(spark, documents(spark, tmp_path, rows)).collect())
    assert got == sorted([(1, rows[0][1], 0), (2, f"{other}\nxyz\nlast line of the long one", 1), (2, rows[2][1], 0),
                          (2, f"middle {line[::-1]}", 1), (2, f"middle {line[::-1]}", 1), (3, "head of the third", 1)])
