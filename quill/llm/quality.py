"""Quality rules with risk-controlled cutoffs.

Fixed base rules reject short and repetitive texts. On top, graded rules
(symbols per word, capital share, exclamation marks per word, repeated lines)
get cutoffs per stratum, chosen on labelled documents so that false rejections
are limited with an exact guarantee:

* the rules' cutoffs form one joint ladder from lax to strict: rung i rejects
  what exceeds the i-th cutoff of any rule. A rung is certified if the exact
  binomial (Clopper-Pearson) upper bound of its rejection rate of good documents
  is at most ``alpha``;
* the ladder is tested in order and stops at the first failure
  (fixed-sequence testing), and the error ``delta`` is split over the strata
  (Bonferroni), so with probability 1 - ``delta`` every stratum loses at most a
  share ``alpha`` of its good documents to all graded rules together. One test
  of the union needs a quarter of the labels that a test per rule would;
* strata whose good labels could not certify anything, whatever they say, form
  one pooled stratum, for which the same holds as a whole;
* among the certified rungs the one that separates the labels best is used
  (the laxer of equals); without one, the graded rules reject nothing there.

Counts per (stratum, rung, label) are one partial aggregation; only a stratum's
own ladder (two rows a rung) meets in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep, sized

ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, REPEAT_PERCENT = 50, 50

#: feature -> cutoffs, lax to strict; a document is rejected above the cutoff
LADDERS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05, 0.03),
    "capital_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15),
    "exclaim_per_word": (2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_letters", "n_exclaim")


def repeated_words(ws: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the list."""
    if len(ws) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in ws), np.int64, len(ws))
    v = len(ids)
    if v < 2_000_000:
        key = (w[:-2] * v + w[1:-1]) * v + w[2:]
    else:                                   # v ** 3 would not fit: rank the pairs first
        pair = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1]
        key = pair[:-1] * v + w[2:]
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    again = n[at] > 1
    inside = np.zeros(len(ws), bool)
    for j in range(3):
        inside[j:j + len(again)] |= again
    return int(inside.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of one whole text (null: all zero)."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8")
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    ws = raw.split()
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line and line.encode("utf-8").split():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    blank = int(c[[9, 10, 11, 12, 13, 32]].sum())
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    return (len(ws), len(text) - blank, int(c[list(b"#*$%&|<>")].sum()), dup,
            repeated_words(ws), lines, upper, upper + lower, int(c[33]))


def _measured(batches):
    for b in batches:
        cols = list(zip(*map(measure, b.column(0).to_pylist()))) or [()] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(b.columns[1:] + [pa.array(c, pa.int64()) for c in cols],
                                         ["id", "text_hash", "stratum", *COUNTS])


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(X <= x) for X ~ Binomial(n, p), by the incomplete beta function."""
    if x >= n:
        return 1.0
    a, b, z = n - x, x + 1, 1 - p          # I_{1-p}(n - x, x + 1)
    flip = z > (a + 1) / (a + b + 2)
    if flip:
        a, b, z = b, a, 1 - z
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(z) + b * math.log1p(-z))
    tiny, c, f = 1e-300, 1.0, 1.0           # continued fraction, modified Lentz
    d = 1 / max(1 - (a + b) * z / (a + 1), tiny)
    f = d
    for m in range(1, 100_000):
        u = m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / ((1 + u * d) or tiny)
        c = (1 + u / c) or tiny
        f *= d * c
        u = -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + u * d) or tiny)
        c = (1 + u / c) or tiny
        f *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    tail = front * f / a
    return 1 - tail if flip else tail


def certified(rejected: list[int], n: int, alpha: float, level: float) -> int:
    """How many rungs of a lax-to-strict ladder hold, tested in order: rung i
    holds if the exact bound of its rate ``rejected[i] / n`` is below ``alpha``."""
    for i, x in enumerate(rejected):
        if n == 0 or binomial_cdf(x, n, alpha) > level:
            return i
    return len(rejected)


def pick_cutoff(ladder, good_above: list[int], n_good: int, bad_above: list[int], n_bad: int,
                alpha: float, level: float) -> float | None:
    """The certified cutoff with the best separation; the laxer of equals."""
    best, at = 0.0, None
    for i in range(certified(good_above, n_good, alpha, level)):
        gain = bad_above[i] / max(n_bad, 1) - good_above[i] / max(n_good, 1)
        if gain > best + 1e-12:
            best, at = gain, ladder[i]
    return at


def _ratio(top, bottom):
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))


def features(docs: DataFrame, id_col="doc_id", text_col="text", stratum_col="lang") -> DataFrame:
    """Counts and graded features of every whole text, plus the base verdict."""
    src = docs.select(F.col(text_col), F.col(id_col).cast("long").alias("id"),
                      F.xxhash64(text_col).alias("text_hash"),
                      F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"))
    out = arrow(src, _measured, "id long, text_hash long, stratum string, "
                + ", ".join(f"{c} long" for c in COUNTS))
    return out.select(
        "*", _ratio("n_symbols", "n_words").alias("symbols_per_word"),
        _ratio("n_upper", "n_letters").alias("capital_share"),
        _ratio("n_exclaim", "n_words").alias("exclaim_per_word"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_share"),
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def choose_cutoffs(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                   ladders: dict = LADDERS) -> DataFrame:
    """``(stratum, <rule>...)``: one row per stratum with labelled good
    documents; a null cutoff rejects nothing."""
    marked = labels.select(F.col("doc_id").cast("long").alias("id"),
                           F.col("quality").cast("int").alias("good")).filter("good in (0, 1)").distinct()
    # documents that the base rules reject are not the graded rules' concern
    seen = feats.filter(~F.col("base_failed")).join(marked, "id")
    rules = list(ladders)
    rungs = max(map(len, ladders.values()))

    def first(r: str):
        """The rule's first rung that rejects the value; ``rungs`` if none does."""
        at = F.size(F.filter(F.array(*map(F.lit, ladders[r])), lambda c: c >= F.col(r)))
        return F.when(at < len(ladders[r]), at).otherwise(rungs)

    counts = keep(seen.select("stratum", "good", F.least(*map(first, rules)).alias("rung"))
                  .groupBy("stratum", "good", "rung").agg(F.count(F.lit(1)).alias("n")))
    strata = counts.filter("good = 1").groupBy("stratum").agg(F.sum("n").alias("n_good"))
    level = delta / max(strata.count(), 1)
    # fewer good labels than this certify nothing even if no rule rejects one
    need = math.log(level) / math.log1p(-alpha)
    group = F.when(F.col("n_good") >= need, F.concat(F.lit("="), "stratum")).otherwise(F.lit("pooled"))
    strata = keep(strata.select("stratum", group.alias("pool")))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        above = {g: [int(pdf[(pdf["good"] == g) & (pdf["rung"] <= i)]["n"].sum()) for i in range(rungs)] for g in (0, 1)}
        n = {g: int(pdf[pdf["good"] == g]["n"].sum()) for g in (0, 1)}
        i = pick_cutoff(range(rungs), above[1], n[1], above[0], n[0], alpha, level)
        row = {r: None if i is None else ladders[r][min(i, len(ladders[r]) - 1)] for r in rules}
        return pd.DataFrame([{"pool": pdf["pool"].iloc[0], **row}], columns=["pool", *rules]).astype(
            {r: "float64" for r in rules})

    of_pool = counts.join(strata, "stratum").groupBy("pool", "good", "rung").agg(F.sum("n").alias("n"))
    chosen = of_pool.groupBy("pool").applyInPandas(choose, "pool string, " + ", ".join(f"{r} double" for r in rules))
    return strata.join(chosen, "pool").select("stratum", *rules)


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
          id_col="doc_id", text_col="text", stratum_col="lang") -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept``, the graded
    rule that rejected it (``reason``, null if none) and the text's hash, which
    with the id tells rows that repeat an id apart.

    Null and empty texts have zero words and fail the base rule. A null
    stratum is a stratum of its own. Repeated rows are judged alike; labels
    that are null or contradict each other count on both sides. Without
    labels (an empty table) no graded rule is certified and only the base
    rules reject. Other columns are ignored, whatever their names.
    """
    feats = keep(features(docs, id_col, text_col, stratum_col))
    cuts = keep(choose_cutoffs(feats, labels, alpha, delta).select(
        "stratum", *[F.col(r).alias(f"cut_{r}") for r in LADDERS]))
    reason = F.coalesce(*[F.when(F.col(r) > F.col(f"cut_{r}"), F.lit(r)) for r in LADDERS])
    return (feats.join(sized(cuts, 128), "stratum", "left")
            .select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & reason.isNull()).alias("kept"),
                    F.when(~F.col("base_failed"), reason).alias("reason"), "text_hash"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all of their columns."""
    bad = keep(judge(docs, labels, id_col=id_col, text_col=text_col, **options).filter("not kept")
               .select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct())
    return docs.join(sized(bad, 32), F.col(id_col).cast("long").eqNullSafe(F.col("_bad_id"))
                     & (F.xxhash64(text_col) == F.col("_bad_text")), "left_anti")
