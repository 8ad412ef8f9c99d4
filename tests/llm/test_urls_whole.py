"""URL rules: mined from the given labels alone, at any table size."""
import random

from quill.llm.queries import page_labels
from quill.llm.urls import filter_urls, mine


def test_labels_alone_mark_pages(spark):
    pages = spark.createDataFrame([(1, "http://casino-win.com/en/10"), (2, "http://news.org/en/11"),
                                   (3, "http://spam-farm.net/en/12"), (4, None)], "page_id long, url string")
    labels = spark.createDataFrame([(10, 1, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in page_labels(pages, labels).collect()} == {(1, False), (2, True)}


def test_base_rate_is_no_rule(spark):
    r = random.Random(4)
    data = [([t for t in "abc" if r.random() < 0.5] + ["x"], r.random() < 0.9) for _ in range(400)]
    df = spark.createDataFrame(data, "items array<string>, bad boolean")
    assert mine(df).collect() == []
    assert mine(df.filter("bad")).collect() == []


def test_support_does_not_grow_with_the_table(spark):
    # 16,000 labelled pages, 12 of them on a bad host: a rule, as in a small table
    pages = spark.range(16_000).selectExpr(
        "id as page_id", "concat('http://', if(id < 12, 'pillmart', concat('news', id % 50)), '.org/en/', id) as url")
    labels = pages.selectExpr("page_id", "page_id < 12 or page_id % 20 = 0 as bad")
    new = spark.createDataFrame([(-1, "https://pillmart.org/fr/1"), (-2, "https://news3.org/fr/1")], pages.schema)
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages.unionByName(new), labels, []).collect()
           if r["page_id"] < 15}
    assert got[-1] == "block" and got[-2] == "allow"
    assert all(got[i] == "block" for i in range(12)) and got[14] == "allow"


def test_long_repeated_urls_are_one_item(spark):
    """60 words in five bad pages, each also in five good pages of its own: 2^60 sets, one rule."""
    words = [f"w{k:02d}" for k in range(60)]
    rows = [(words, True)] * 5 + [([w, f"g{k}"], False) for k, w in enumerate(words)] * 5
    rows += [([f"h{k}", "z"], False) for k in range(400)]
    rules = mine(spark.createDataFrame(rows, "items array<string>, bad boolean")).collect()
    assert len(rules) == 1 and rules[0].confidence == 1.0 and sorted(rules[0].need) == words
    url = "https://junk.org/" + "/".join(words)
    pages = [(k, url) for k in range(5)] + [(10 + 60 * n + k, f"https://good{k}.org/{w}") for k, w in enumerate(words) for n in range(5)]
    pages += [(400 + k, f"https://plain{k % 9}.org/z") for k in range(400)] + [(1000, url + "/more"), (1001, "https://junk.org/w01")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    labels = df.filter("page_id < 1000").selectExpr("page_id", "page_id < 5 as bad")
    got = {r.page_id: r.verdict for r in filter_urls(df, labels, []).collect()}
    assert got[0] == got[1000] == "block" and got[10] == got[400] == "allow"


def test_no_rule_is_missing(spark):
    """Every most confident token set that beats chance is there, by trying all sets."""
    import itertools
    import math

    r = random.Random(9)
    data = []
    for _ in range(500):
        items = [t for t in "abcdef" if r.random() < 0.4]
        data.append((items, {"a", "b"} <= set(items) or ("c" in items and r.random() < 0.85) or r.random() < 0.05))
    got = {frozenset(x.need): x.confidence for x in mine(spark.createDataFrame(data, "items array<string>, bad boolean")).collect()}
    sets = [(set(i), b) for i, b in data if i]
    base = sum(b for _, b in sets) / len(sets)
    conf = {}
    for n in range(1, 7):
        for need in itertools.combinations("abcdef", n):
            hit = [b for i, b in sets if set(need) <= i]
            if sum(hit) >= 5:
                conf[frozenset(need)] = (sum(hit) / len(hit), sum(hit), len(hit))
    for need, (c, hits, freq) in conf.items():
        narrow = any(need > less and conf[less][0] >= c for less in conf)
        chance = sum(math.comb(freq, k) * (1 - base) ** k * base ** (freq - k) for k in range(freq - hits + 1))
        if c >= 0.8 and not narrow and chance <= 0.05 / (2 * len(conf)):
            assert need in got and abs(got[need] - c) < 1e-12
    assert frozenset("ab") in got and frozenset("c") in got
