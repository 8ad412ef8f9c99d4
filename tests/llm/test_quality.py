import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quill.llm.quality import (binomial_cdf, certified, choose_cutoffs, features, judge, keep_good, measure,
                               pick_cutoff)

from llm_helpers import sentence

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(tuple(ws[k:k + 3]) for k in range(len(ws) - 2))
    hit = {k + j for k in range(len(ws) - 2) if tri[tuple(ws[k:k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(hit))


def test_measure_matches_brute_force(spark, sf_small):
    r = random.Random(1)
    alphabet = ["a", "b", "é", "中", " ", "\n", "\t", "\x0b", "\x0c", "\r", "#", "|", " ", "\u0085", "a b c ", "\n\n"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(800)]
    texts += [None, "", " ", "x y z x y z", "x y z x y", "a a a a"]
    texts += [x["text"] for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    for t in texts:
        assert measure(t)[:5] == brute(t), t


def exact_cdf(x, n, p):
    return math.fsum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(x + 1))


@pytest.mark.parametrize("n", [1, 2, 10, 97, 400])
def test_binomial_cdf(n):
    for p in (0.001, 0.0125, 0.3, 0.5, 0.97):
        for x in {0, 1, n // 10, n // 2, n - 1, n}:
            assert binomial_cdf(x, n, p) == pytest.approx(exact_cdf(x, n, p), rel=1e-9, abs=1e-13)


def test_certified_ladder_is_an_exact_bound():
    # no false rejection among n: certified from n = log(level) / log(1 - alpha) on
    assert certified([0], 100, 0.05, 0.01) == 1 and certified([0], 80, 0.05, 0.01) == 0
    # the ladder stops at the first failure even if a later rung would pass
    assert certified([0, 90, 0], 1000, 0.05, 0.01) == 1
    # the laxer of equally good cutoffs
    assert pick_cutoff((3, 2, 1), [0, 0, 0], 1000, [50, 80, 80], 100, 0.05, 0.01) == 2
    assert pick_cutoff((3, 2, 1), [0, 0, 0], 10, [50, 80, 80], 100, 0.05, 0.01) is None


def corpus(n, seed):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = sentence(r, 60 + r.randrange(60))
        if bad:
            text = " | ".join(text.split(" "))
        docs.append((i, text, "en" if i % 4 else "fr"))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_learned_cutoffs_and_guarantee(spark):
    docs, labels = corpus(4000, 2)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in judge(d, lab).collect()}
    assert all(got[i]["kept"] == (i % 5 != 0) for i, _, _ in docs)
    assert all(got[i]["reason"] == "symbols_per_word" for i in range(0, 4000, 5))
    # 80 good labels certify the two strata together, neither of them alone
    pooled = judge(d, lab.limit(100)).collect()
    assert all(r["kept"] == (r["doc_id"] % 5 != 0) for r in pooled)
    # with fewer labels nothing is certified and clean documents stay
    few = judge(d, lab.limit(50)).collect()
    assert all(r["kept"] for r in few)


def test_guarantee_by_simulation():
    """True false rejections of the chosen rung exceed alpha in at most a share delta
    of the draws, whatever the labels make look best."""
    r = random.Random(4)
    alpha, level, draws, broken, used = 0.05, 0.05, 400, 0, 0
    true = [0.0, 0.01, 0.03, 0.045, 0.06, 0.09, 0.2]          # of good documents, per rung
    found = [0.1, 0.2, 0.3, 0.5, 0.8, 0.9, 1.0]               # of bad ones
    for _ in range(draws):
        n = r.choice([90, 230, 900])
        first = [sum(u >= t for t in true) for u in (r.random() for _ in range(n))]
        good = [sum(f <= i for f in first) for i in range(len(true))]
        bad = [round(100 * x) for x in found]
        at = pick_cutoff(range(len(true)), good, n, bad, 100, alpha, level)
        used += at is not None
        broken += at is not None and true[at] > alpha
    assert used > 0.9 * draws and broken <= (level + 0.03) * draws


def _plain_verdicts(docs, labels, alpha=0.05, delta=0.05):
    """The whole verdict by loops: counts, ladder, bounds, pooled strata."""
    from quill.llm.quality import LADDERS
    good = {}
    for i, q, _ in labels:
        good.setdefault(i, set()).add(q)
    feats, base = {}, {}
    for i, t, lang in docs:
        n, _, sym, dup, rep, lines, upper, letters, bang = measure(t)
        feats[i] = {"symbols_per_word": sym / n if n else 0, "capital_share": upper / letters if letters else 0,
                    "exclaim_per_word": bang / n if n else 0, "dup_line_share": dup / lines if lines else 0}
        base[i] = n < 50 or 100 * rep > 50 * n
    rungs = max(map(len, LADDERS.values()))

    def rejects(i, k):
        return any(feats[i][r] > c[min(k, len(c) - 1)] for r, c in LADDERS.items())

    langs = {lang for i, _, lang in docs if 1 in good.get(i, ()) and not base[i]}
    level = delta / max(len(langs), 1)
    n_good = {lang: sum(1 in good.get(i, ()) and not base[i] for i, _, x in docs if x == lang) for lang in langs}
    pool = {lang: lang if (1 - alpha) ** n <= level else None for lang, n in n_good.items()}
    rung = {}
    for p in set(pool.values()):
        own = [i for i, _, lang in docs if lang in pool and pool[lang] == p and not base[i]]
        yes, no = [i for i in own if 1 in good.get(i, ())], [i for i in own if 0 in good.get(i, ())]
        best, at = 0.0, None
        for k in range(rungs):
            x = sum(rejects(i, k) for i in yes)
            if not yes or exact_cdf(x, len(yes), alpha) > level:
                break
            gain = sum(rejects(i, k) for i in no) / max(len(no), 1) - x / len(yes)
            if gain > best + 1e-12:
                best, at = gain, k
        rung[p] = at
    return {i: not base[i] and not (lang in pool and rung[pool[lang]] is not None and rejects(i, rung[pool[lang]]))
            for i, _, lang in docs}


def test_verdicts_equal_brute_force(spark, sf_small):
    docs, labels = corpus(1200, 6)
    docs = [(i, t, "en" if i % 3 else "fr" if i % 2 else f"x{i % 5}") for i, t, _ in docs]
    docs += [(9000 + k, "SHOUT LOUD " * 5 + sentence(random.Random(k), 60).upper(), "en") for k in range(40)]
    labels += [(9000 + k, k % 3 == 0, 0) for k in range(30)] + [(5, 0, 0), (5, 1, 0)]
    labels = [(i, int(q), t) for i, q, t in labels]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: r["kept"] for r in judge(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got == _plain_verdicts(docs, labels) and 0 < sum(got.values()) < len(got)
    d = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang")
    lab = spark.read.parquet(f"{sf_small}/labels.parquet").select("doc_id", "quality", "toxic")
    got = {r["doc_id"]: r["kept"] for r in judge(d, lab).collect()}
    assert got == _plain_verdicts([tuple(r) for r in d.collect()], [tuple(r) for r in lab.collect()])


def test_noise_is_limited_per_stratum(spark):
    # good documents that look bad limit the cutoff: at most alpha of them may go
    docs, labels = corpus(4000, 3)
    labels = [(i, 1 if i % 40 == 0 else q, t) for i, q, t in labels]      # 10 % of the junk is called good
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = judge(d, lab).join(lab, "doc_id").filter("quality = 1").join(d.select("doc_id", "lang"), "doc_id")
    for r in out.groupBy("lang").agg(F.avg(F.when(F.col("kept"), 0).otherwise(1)).alias("lost")).collect():
        assert r["lost"] <= 0.05
    cuts = choose_cutoffs(features(d), lab).collect()
    assert {c["stratum"] for c in cuts} == {"en", "fr"}


def test_nasty(spark, nasty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = judge(nasty, none)
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["base_failed"], r["kept"]))
    assert got[2] == [(0, True, False)] and got[3] == [(0, True, False)] and got[4] == [(0, True, False)]
    assert got[1] == [(7, True, False)] * 2 and len(got[None]) == 2
    assert got[5] == [(36000, False, True)]
    assert judge(nasty.limit(0), none).collect() == []
    odd = spark.createDataFrame([(5, 0, 0), (5, 1, 0), (5, None, 0), (None, 1, 0), (6, 1, 0), (6, 1, 0)],
                                "doc_id long, quality int, toxic int")
    assert judge(nasty, odd).count() == nasty.count()
    kept = keep_good(nasty, none)
    assert kept.columns == nasty.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 6]
