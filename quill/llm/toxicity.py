"""Toxicity by a weighted finite-state pattern grammar.

Matched clauses are scored, not isolated words. Four transducers rewrite a
clause's words to symbols, and an automaton composes them:

* insult: weighted arcs for whole words and word stems, learned from labels on
  top of a few fixed words;
* threat: fixed verbs of violence, which say nothing without a target;
* target: second-person forms;
* negation and reported speech: words that open a scope over what follows.

An arc's weight is the log-ratio of its rates (occurrences per character) in
toxic and clean documents. A match leaves a clause on a path: its class
(insult, threat), whether the clause has a target, and its scope (free, negated,
reported). Free insults and free targeted threats give their arcs' weights, a
target adds to them. On every other path the weights are replaced by the path's
own log-ratio, which is learned within narrow bounds around nothing: "you are
not an idiot" is no insult, however telling the word. A document's log-odds are the prior, plus its clauses, minus what
a toxic text of its length would be expected to hold (a Poisson likelihood
ratio: one rare stem in a long text says little, several in a short one say
much); or the same for its strongest run of clauses, less the logarithm of how
many such runs the text has room for, if that is more: clean text around an
abusive passage does not drown it. A monotone calibration on
labelled documents that the lexicon has not seen turns them into a probability.

Everything is learned from at most ``max_labels`` labelled documents (in order
of a hash), the documented bound of the fit; scoring covers all documents and
whole texts. Held-out labels (crc32 of the id, mod 4, equal to 2) are never
read. Nothing but texts enters a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep
from quill.llm.quality import binomial_cdf

MAX_LABELS = 16_000
MIN_DOCS = 4             # toxic documents that a learned arc needs
MIN_WEIGHT = 2.0         # log-ratio of rates that a learned arc needs
CHANCE = 0.05            # probability that any learned arc is there by chance
HELD_OUT, FOLDS = 2, 4
CALIBRATION_FOLD = 3
STEM = (3, 12)           # length of learned stems

# Fixed words per class, in English, German, French and Spanish.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting",
           "dumm", "abschaum", "arschloch", "crétin", "imbécile", "ordure", "imbécil", "estúpido", "basura")
THREATS = ("kill", "hurt", "stab", "shoot", "beat", "töten", "umbringen", "schlagen", "tuer", "frapper",
           "matar", "golpear")
TARGETS = frozenset(("you", "your", "youre", "yourself", "du", "dich", "dir", "dein", "ihr", "euch", "tu",
                     "toi", "vous", "votre", "tú", "usted", "ustedes", "vosotros"))
NEGATIONS = frozenset(("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie",
                       "pas", "jamais", "ni", "nunca", "tampoco"))
REPORTS = frozenset(("said", "says", "called", "wrote", "claimed", "quoted", "sagte", "nannte", "schrieb",
                     "dit", "appelle", "écrit", "dijo", "llamó", "escribió"))
#: occurrences that a fixed word counts as having in toxic and clean texts
FIXED_COUNTS = {"insult": (1.0, 0.02), "threat": (1.0, 0.15)}
#: log-ratio of a path before any label (what a target adds to a free match; what
#: replaces the arcs' weights elsewhere), its bounds, and the documents the prior counts for
PATHS = {"insult/plain/free": (0.0, 0.0, 0.0), "insult/targeted/free": (1.0, 0.5, 2.0),
         "threat/targeted/free": (1.0, 0.5, 2.0)}
ELSEWHERE = (0.0, -0.5, 0.5)
PRIOR_DOCS = 20.0
SCOPE = 4                # words that a negation covers
LEAST_RUN = 200          # characters that a run of clauses counts as having at least
BINS = (-30.0, -8.0, -5.0, -3.0, -2.0, -1.0, 0.0, 1.0, 2.0, 3.0, 5.0, 8.0, 30.0)

_CLAUSE = re.compile(r"[^.!?;\n]+")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def arcs_of(text: str | None) -> dict[str, list]:
    """Arcs a text can take, its words and ``stem*`` for proper stems of them:
    ``[occurrences, smallest word, largest word]``."""
    out: dict[str, list] = {}
    for w, n in Counter(_WORD.findall(text.lower())).items() if text else ():
        if len(w) < STEM[0]:
            continue
        for arc in (w, *(w[:k] + "*" for k in range(STEM[0], min(len(w) - 1, STEM[1]) + 1))):
            x = out.get(arc)
            if x is None:
                out[arc] = [n, w, w]
            else:
                x[0] += n
                x[1], x[2] = min(x[1], w), max(x[2], w)
    return out


class Grammar:
    """The insult and threat transducers as one automaton over characters, and
    the clause automaton over word classes. ``weights``: arc -> log-ratio."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        arcs: dict[str, dict[str, tuple]] = {}
        for arc, value in weights.items():
            kind = "threat" if arc in THREATS else "insult"
            arcs.setdefault(arc.rstrip("*"), {})["stem" if arc[-1] == "*" else "word"] = (value, kind)
        self.auto = ahocorasick.Automaton()
        for stem, found in arcs.items():
            self.auto.add_word(stem, (len(stem), found))
        self.auto.make_automaton()

    def words(self, low: str) -> dict[int, tuple[float, str]]:
        """Position of a word -> largest weight of its arcs, and that arc's class."""
        out: dict[int, tuple[float, str]] = {}
        n = len(low)
        for last, (size, found) in self.auto.iter(low):
            at = last + 1 - size
            if at and low[at - 1].isalnum():
                continue
            inside = last + 1 < n and low[last + 1].isalnum()
            arc = found.get("stem" if inside else "word")
            if arc is not None and (at not in out or arc > out[at]):
                out[at] = arc
        return out

    def clauses(self, text: str | None) -> list[tuple[dict[str, float], int, int]]:
        """``(paths, start, end)`` of every matched clause; ``paths`` has the sum of
        the arcs' weights per path."""
        if not text:
            return []
        low = text.lower()
        hits = sorted(self.words(low).items())
        if not hits:
            return []
        out, k = [], 0
        for c in _CLAUSE.finditer(low):
            if k == len(hits):
                break
            if hits[k][0] >= c.end():
                continue
            inside = {}
            while k < len(hits) and hits[k][0] < c.end():
                inside[hits[k][0]] = hits[k][1]
                k += 1
            out.append((self.compose(low, c.start(), c.end(), inside), c.start(), c.end()))
        return out

    def compose(self, low: str, start: int, end: int, hits: dict[int, tuple[float, str]]) -> dict[str, float]:
        """Runs the clause's word classes through the automaton. Its state: whether a
        report is open, how many words the last negation still covers, and
        which classes have matched in which scope; the target closes the paths."""
        matched: dict[tuple[str, str], float] = {}
        targeted = reported = False
        negation = 0
        for m in _WORD.finditer(low, start, end):
            w = m.group()
            if m.start() in hits:
                weight, kind = hits[m.start()]
                scope = "reported" if reported else "negated" if negation else "free"
                matched[kind, scope] = matched.get((kind, scope), 0.0) + weight
            targeted = targeted or w in TARGETS
            reported = reported or w in REPORTS
            negation = SCOPE if w in NEGATIONS else max(negation - 1, 0)
        target = "targeted" if targeted else "plain"
        return {f"{kind}/{target}/{scope}": w for (kind, scope), w in matched.items()}


class Model:
    """``weights`` of arcs, ``worth`` of paths, the log-odds of the prior, the
    expected weight per character, and the calibrated level of each bin."""

    def __init__(self, weights: dict[str, float], worth: dict[str, float], prior: float, per_char: float,
                 levels: list[float] | None = None):
        self.weights, self.worth, self.levels = weights, worth, levels
        self.prior, self.per_char = prior, per_char

    def value(self, paths: dict[str, float]) -> float:
        """What a clause says: weights where a path passes them on, else its own."""
        return sum((w if path in PATHS else 0.0) + self.worth.get(path, 0.0) for path, w in paths.items())

    def log_odds(self, clauses: list[tuple[dict[str, float], int, int]], size: int) -> float:
        """The larger of the whole text's ratio and its strongest run's."""
        whole = -self.per_char * size
        run, begin, best, span, last = 0.0, 0, 0.0, 0, 0
        for paths, start, end in clauses:
            v = self.value(paths)
            whole += v
            run -= self.per_char * (end - last)
            own = v - self.per_char * (end - start)
            if run + v > own:
                run += v
            else:
                run, begin = own, start
            last = end
            if run > best:
                best, span = run, end - begin
        room = max(size / max(span, LEAST_RUN), 1.0)
        return self.prior + max(whole, best - math.log(room) if best else -math.inf)

    def score(self, z: float) -> float:
        """Calibrated probability: the bin's level, rising inside the bin."""
        z = min(max(z, BINS[0]), BINS[-1] - 1e-9)
        k = max(i for i, b in enumerate(BINS[:-1]) if z >= b)
        up = self.levels[k + 1] if k + 1 < len(self.levels) else 1.0
        inside = (z - BINS[k]) / (BINS[k + 1] - BINS[k])
        return min(max(self.levels[k] + 0.5 * (up - self.levels[k]) * inside, 0.0), 1.0)


def _arcs(wanted: frozenset | None):
    """Documents and occurrences per arc; with ``wanted``, only of these arcs."""
    def run(batches):
        n: dict[str, list] = {}
        for b in batches:
            for text in b.column(0).to_pylist():
                for arc, (k, lo, hi) in arcs_of(text).items():
                    if wanted is None or arc in wanted:
                        x = n.get(arc)
                        if x is None:
                            n[arc] = [1, k, lo, hi]
                        else:
                            x[0] += 1
                            x[1] += k
                            x[2], x[3] = min(x[2], lo), max(x[3], hi)
        rows = list(n.items())
        for i in range(0, len(rows), 50_000):
            part = rows[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.string())]
                + [pa.array([r[1][k] for r in part], pa.int64() if k < 2 else pa.string()) for k in range(4)],
                ["arc", "docs", "n", "lo", "hi"])
    return run


def _paths(weights: dict[str, float]):
    """Paths of each document, with the weight on them, and its label."""
    def run(batches):
        g = Grammar(weights)
        for b in batches:
            path, weight, toxic = [], [], []
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found: dict[str, float] = {}
                for paths, _, _ in g.clauses(text):
                    for p, w in paths.items():
                        found[p] = found.get(p, 0.0) + w
                path += found
                weight += found.values()
                toxic += [label] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(weight, pa.float64()),
                                              pa.array(toxic, pa.bool_())], ["path", "weight", "toxic"])
    return run


def path_worth(met: dict[tuple[str, bool], int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log-ratio of every path from the documents of each label that have it,
    against the plain free insult where a path passes weights on."""
    def ratio(path: str) -> tuple[float, int]:
        t, c = met.get((path, True), 0), met.get((path, False), 0)
        return math.log((t + 0.5) / (n_toxic + 1) * (n_clean + 1) / (c + 0.5)), t + c

    base = ratio("insult/plain/free")[0]
    out = {}
    for path in {p for p, _ in met} | set(PATHS):
        prior, low, high = PATHS.get(path, ELSEWHERE)
        said, n = ratio(path)
        said -= base if path in PATHS else 0.0
        out[path] = min(max((said * n + prior * PRIOR_DOCS) / (n + PRIOR_DOCS), low), high)
    return out


def _log_odds(model: Model):
    def run(batches):
        g = Grammar(model.weights)
        for b in batches:
            z = [model.log_odds(g.clauses(t), len(t or "")) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.float64()), b.column(1)], ["z", "toxic"])
    return run


def choose_arcs(toxic: dict[str, tuple], clean: dict[str, tuple], n_toxic: int, n_clean: int,
                size_toxic: float, size_clean: float) -> tuple[dict[str, float], float]:
    """Weights of the kept arcs and their expected total per character, from
    ``arc -> (documents, occurrences, smallest word, largest word)``.

    A stem must stand for two words at least. Of arcs that extend each other
    the one that explains most toxic occurrences is kept."""
    prior = (n_toxic + 1) / (n_toxic + n_clean + 2)
    fixed = {w: FIXED_COUNTS[k] for k, ws in (("insult", INSULTS), ("threat", THREATS)) for w in ws}
    found = []
    for arc in {*toxic, *fixed}:
        d1, t, lo, hi = toxic.get(arc, (0, 0, "", ""))
        d0, c = clean.get(arc, (0, 0))[:2]
        add1, add0 = fixed.get(arc, (0.5, 0.5))
        r1, r0 = (t + add1) / (size_toxic + 1e4), (c + add0) / (size_clean + 1e4)
        weight = math.log(r1 / r0)
        if arc not in fixed and (
                weight < MIN_WEIGHT or (arc[-1] == "*" and lo == hi)
                or binomial_cdf(d0, d1 + d0, 1 - prior) > CHANCE / max(len(toxic), 1)):
            continue
        if weight > 0:
            found.append(((t + add1) * weight, arc, weight, r1 - r0 if t else 0.0))
    found.sort(key=lambda x: (-x[0], x[1]))
    weights: dict[str, float] = {}
    stems: set[str] = set()
    inner: set[str] = set()          # every prefix of a kept arc
    per_char = 0.0
    for _, arc, weight, rate in found:
        body = arc.rstrip("*")
        if (arc[-1] == "*" and body in inner) or any(body[:k] in stems for k in range(1, len(body))) or (
                arc[-1] == "*" and body in stems):
            continue
        weights[arc] = weight
        per_char += rate
        if arc[-1] == "*":
            stems.add(body)
        inner.update(body[:k] for k in range(1, len(body)))
    return weights, per_char


def monotone(rates: list[tuple[float, float]]) -> list[float]:
    """Pool adjacent violators over ``(toxic, documents)`` of ascending bins."""
    pools: list[list[float]] = []
    for hit, n in rates:
        pools.append([hit, n, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            h, m, k = pools.pop()
            pools[-1] = [pools[-1][0] + h, pools[-1][1] + m, pools[-1][2] + k]
    return [p[0] / p[1] for p in pools for _ in range(int(p[2]))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_labels: int = MAX_LABELS) -> Model:
    """Learns from at most ``max_labels`` labelled documents outside the held-out
    fold: arcs and contexts from two folds, the calibration from the third."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("toxic") == 1).alias("toxic"))
           .filter("id is not null and toxic is not null").withColumn("fold", fold(F.col("id")))
           .filter(F.col("fold") != HELD_OUT)
           .groupBy("id", "fold").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("id"), "id").limit(max_labels))
    ids = F.broadcast(keep(ids))            # at most ``max_labels`` rows
    known = keep(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                 .join(ids, "id").select("text", "toxic", "fold"))
    learn = known.filter(F.col("fold") != CALIBRATION_FOLD).select("text", "toxic")
    seen = {r["toxic"]: r for r in learn.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size")).collect()}
    n = {t: seen[t]["n"] if t in seen else 0 for t in (True, False)}
    size = {t: seen[t]["size"] if t in seen else 0 for t in (True, False)}

    def counts(frame: DataFrame, wanted: frozenset | None) -> DataFrame:
        return (arrow(frame.select("text"), _arcs(wanted), "arc string, docs long, n long, lo string, hi string")
                .groupBy("arc").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                                    F.min("lo").alias("lo"), F.max("hi").alias("hi")))

    # of the bounded sample, every arc of MIN_DOCS toxic documents
    toxic = {r["arc"]: tuple(r)[1:] for r in counts(learn.filter("toxic"), None)
             .filter(F.col("docs") >= MIN_DOCS).collect()}
    clean = {r["arc"]: tuple(r)[1:] for r in counts(
        learn.filter("not toxic"), frozenset((*toxic, *INSULTS, *THREATS))).collect()}
    weights, per_char = choose_arcs(toxic, clean, n[True], n[False], size[True], size[False])

    seen_on = arrow(learn, _paths(weights), "path string, weight double, toxic boolean").groupBy("path", "toxic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).collect()
    worth = path_worth({(r["path"], r["toxic"]): r["n"] for r in seen_on}, n[True], n[False])
    # what is expected per character is what free paths pass on
    all_on = sum(r["weight"] for r in seen_on if r["toxic"])
    per_char *= sum(r["weight"] for r in seen_on if r["toxic"] and r["path"] in PATHS) / all_on if all_on else 1.0

    share = (n[True] + 1) / (n[True] + n[False] + 10)
    model = Model(weights, worth, math.log(share / (1 - share)), per_char)
    step = sum((F.col("z") >= b).cast("int") for b in BINS[1:-1])
    bins = {(r["k"], r["toxic"]): r["n"] for r in
            arrow(known.filter(F.col("fold") == CALIBRATION_FOLD).select("text", "toxic"),
                  _log_odds(model), "z double, toxic boolean")
            .groupBy(step.alias("k"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # four documents' worth of what the log-odds say by themselves
    said = [1 / (1 + math.exp(-(BINS[k] + BINS[k + 1]) / 2)) for k in range(len(BINS) - 1)]
    model.levels = monotone([(bins.get((k, True), 0) + 4 * p,
                              bins.get((k, True), 0) + bins.get((k, False), 0) + 4.0) for k, p in enumerate(said)])
    return model


def _scored(model: Model):
    def run(batches):
        g = Grammar(model.weights)
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [g.clauses(t) for t in texts]
            score = [model.score(model.log_odds(c, len(t or ""))) for c, t in zip(found, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score, pa.float64()), pa.array(map(len, found), pa.int64())],
                ["doc_id", "score", "n_clauses"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3, max_labels: int = MAX_LABELS) -> DataFrame:
    """One row per input row: ``(doc_id, held_out, score, predicted, n_clauses)``.

    Null and empty texts match no clause and get the score of the prior; a
    null id stays null (held out is null). Very long texts are scored whole, and
    by their strongest run of clauses. Repeated rows get equal scores; a
    document labelled twice is toxic if one label says so; null labels are
    left out. Without labels the fixed words and priors score alone. Other
    columns are ignored, whatever their names.
    """
    model = fit(docs, labels, id_col, text_col, max_labels)
    out = arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), _scored(model),
                "doc_id long, score double, n_clauses long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses")
