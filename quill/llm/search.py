"""Ranked lexical search by hashed max-sketches.

1. one pass folds every document into a sketch: each of its terms goes to
   ``HASHES`` coordinates, and a coordinate keeps the maximum of what falls on
   it. An impact grows with the term's count for a document's given length, so
   the sketch holds counts, and impacts are had from them once the corpus
   totals are known. The width follows the number of distinct terms, so the
   share of false hits does not grow with a document;
2. a second pass counts in how many documents each query term occurs;
3. a batch of queries looks its terms up in every sketch: the smallest of a
   term's coordinates bounds its count, the sum of weighted impacts bounds the
   score. The best ``k`` bounds of each query are rescored exactly on the texts
   and give its threshold;
4. documents whose bound reaches the threshold are rescored in waves of falling
   bound; the threshold rises, until no bound is left that reaches it.

The result is exact: a bound is never below the score. Queries come in blocks
of bounded bytes; a block's terms travel with the tasks, and its thresholds
(``k`` scores a query) are all that the driver sees.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep

TOP = 10
WIDTH, HASHES = 16, 3          # coordinates per distinct term (at least), and per term
MOST = 255                     # a coordinate's greatest value: any count from here on
BLOCK_ITEMS, BLOCK_BYTES = 1000, 4 << 20
CELLS = 1 << 22                # bounds looked up at once: documents x terms
LEVELS = 256                   # steps of a query's bounds, from its threshold up
WAVE, GROWTH = 64, 16          # documents of a query's first wave, and the next ones' factor
SALTS = 32                     # parts in which a query's best are found before they meet
#: fixed values of the ranking: share of the length in an impact, and the scales
LENGTH_SHARE, WEIGHT_SCALE, IMPACT_SCALE, COUNT_SCALE, LENGTH_SCALE = 75, 1000, 1_000_000_000, 1000, 8

_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and characters beyond ASCII
    (UTF-8), only A-Z lower-cased."""
    return text.encode("utf-8").translate(_TERM_BYTES).split() if text else []


def term_weight(documents: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * df + 1)))


def length_norm(n, documents: int, total: int):
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total


def impact(tf, norm):
    return (IMPACT_SCALE * tf) // (COUNT_SCALE * tf + LENGTH_SCALE * norm)


def hashes(found) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def coordinates(h: np.ndarray, width: int) -> list[np.ndarray]:
    """The places of terms (by hash) in a sketch whose width is a power of two."""
    step = h >> np.uint64(32) | np.uint64(1)
    return [((h + np.uint64(j) * step) & np.uint64(width - 1)).astype(np.int64) for j in range(HASHES)]


def sketch(counts: dict[bytes, int]) -> bytes:
    width = 1 << (WIDTH * len(counts) - 1).bit_length()
    h = hashes(counts)
    tf = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MOST).astype(np.uint8)
    rising = np.argsort(tf, kind="stable")       # where two meet, the later, greater one stays
    h, tf = h[rising], tf[rising]
    out = np.zeros((HASHES, width), np.uint8)
    for row, at in zip(out, coordinates(h, width)):
        row[at] = tf
    return out.max(axis=0).tobytes()


def _sketched(batches):
    for b in batches:
        rows = []
        for i, text, th in zip(*(b.column(k).to_pylist() for k in range(3))):
            found = terms(text)
            if found:
                rows.append((i, th, len(found), sketch(Counter(found))))
        cols = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc", "th", "n", "sketch"])


def max_sketches(docs: DataFrame) -> DataFrame:
    """``docs(doc, text, th)`` -> ``(doc, th, n, sketch)`` of every document that
    has a term; ``n`` counts its terms with repeats."""
    return arrow(docs.select("doc", "text", "th"), _sketched, "doc long, th long, n long, sketch binary")


class Block:
    """A block of queries: their terms, postings from terms to queries, weights."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.ids = [i for i, _ in items]
        self.counts = [Counter(found) for _, found in items]
        self.terms = sorted(set().union(*self.counts)) if items else []

    def weigh(self, df: dict[bytes, int], documents: int, total: int):
        """Terms that no document holds are left out."""
        self.documents, self.total = documents, total
        self.weight = {t: term_weight(documents, df[t]) for t in self.terms if t in df}
        self.terms = [t for t in self.terms if self.weight.get(t)]
        self.hashes = hashes(self.terms)
        place = {t: k for k, t in enumerate(self.terms)}
        posts: list[list] = [[] for _ in self.terms]
        for q, counts in enumerate(self.counts):
            for t, times in counts.items():
                if t in place:
                    posts[place[t]].append((q, self.weight[t] * times))
        self.fan = np.array([len(p) for p in posts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.fan)])
        self.query = np.array([q for p in posts for q, _ in p], np.int64)
        self.gain = np.array([g for p in posts for _, g in p], np.float64)
        return self

    def score(self, q: int, counts: dict[bytes, int], n: int) -> int:
        norm = length_norm(n, self.documents, self.total)
        return sum(w * times * impact(counts[t], norm)
                   for t, times in self.counts[q].items() if t in counts and (w := self.weight.get(t)))

    def bounds(self, n: np.ndarray, sketches: list[bytes]) -> np.ndarray:
        """Upper bounds, documents x queries (whole numbers below 2^53)."""
        out = np.zeros((len(n), len(self.ids)))
        width = np.array([len(s) for s in sketches])
        room = max(CELLS // max(len(self.terms), 1), 1)
        for w in np.unique(width).tolist():
            spots = coordinates(self.hashes, w)
            of_width = np.flatnonzero(width == w)
            for k in range(0, len(of_width), room):
                rows = of_width[k:k + room]
                cells = np.frombuffer(b"".join([sketches[r] for r in rows]), np.uint8).reshape(len(rows), w)
                tf = cells[:, spots[0]]
                for at in spots[1:]:
                    np.minimum(tf, cells[:, at], out=tf)
                doc, term = np.nonzero(tf)
                size = n[rows][doc]
                most = tf[doc, term].astype(np.int64)
                most = np.where(most == MOST, np.maximum(size, MOST), most)
                gain = impact(most, length_norm(size, self.documents, self.total)).astype(np.float64)
                fan = self.fan[term]
                at = np.repeat(self.first[term] - np.concatenate([[0], np.cumsum(fan)[:-1]]), fan) + np.arange(fan.sum())
                cell = np.repeat(doc, fan) * len(self.ids) + self.query[at]
                out[rows] = np.bincount(cell, np.repeat(gain, fan) * self.gain[at],
                                        len(rows) * len(self.ids)).reshape(len(rows), -1)
        return out


def _columns(b):
    """Ids may be null, so they stay Arrow values."""
    return b.column(0), b.column(1), b.column(2).to_numpy(), b.column(3).to_pylist()


def _best(block: Block, k: int):
    """The ``k`` best bounds of every query within a partition."""
    def run(batches):
        best: list[list] = [[] for _ in block.ids]
        for b in batches:
            if not b.num_rows:
                continue
            doc, th, n, sketches = _columns(b)
            bound = block.bounds(n, sketches)
            top = np.argpartition(-bound, min(k, len(n)) - 1, axis=0)[:k]
            for q in range(len(block.ids)):
                at = top[:, q][bound[top[:, q], q] > 0]
                best[q] += [(int(bound[r, q]), doc[r].as_py(), th[r].as_py()) for r in at.tolist()]
                best[q] = sorted(best[q], key=lambda row: -row[0])[:k]
        rows = [(q, d, t, s) for q, own in enumerate(best) for s, d, t in own]
        cols = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["q", "doc", "th", "bound"])
    return run


def _reaching(block: Block, floor: np.ndarray, step: np.ndarray):
    """All bounds above 0 that reach their query's threshold, and their level."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            doc, th, n, sketches = _columns(b)
            bound = block.bounds(n, sketches)
            row, q = np.nonzero((bound >= floor) & (bound > 0))
            found = bound[row, q]
            level = np.minimum((found - floor[q]) // step[q], LEVELS - 1)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), doc.take(at), th.take(at), pa.array(found.astype(np.int64)),
                 pa.array(level.astype(np.int32))], ["q", "doc", "th", "bound", "level"])
    return run


def _scored(block: Block):
    """(doc, text, queries) -> exact scores above 0."""
    def run(batches):
        for b in batches:
            qs, doc, score = [], [], []
            for i, text, wanted in zip(*(b.column(k).to_pylist() for k in range(3))):
                found = terms(text)
                counts = Counter(found)
                for q in wanted:
                    s = block.score(q, counts, len(found))
                    if s > 0:
                        qs.append(q)
                        doc.append(i)
                        score.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int32()), pa.array(doc, pa.int64()),
                                              pa.array(score, pa.int64())], ["q", "doc", "score"])
    return run


def _counted(block: Block):
    """Documents of a partition that hold each term of the block."""
    def run(batches):
        wanted, seen = set(block.terms), Counter()
        for b in batches:
            for text in b.column(0):
                seen.update(wanted.intersection(terms(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         ["term", "df"])
    return run


def _top(rows: DataFrame, k: int, by: str) -> DataFrame:
    """The ``k`` first rows of each query by ``by`` falling, then ``doc``: within
    parts first, so that no task ranks all that a query has."""
    order = [F.col(by).desc(), F.col("doc").asc_nulls_last()]
    part = Window.partitionBy("q", F.pmod(F.xxhash64("doc"), F.lit(SALTS))).orderBy(*order)
    few = rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[Block]:
    block, size = [], 0
    for i, text in items.toLocalIterator():
        found = terms(text)
        if block and (len(block) == BLOCK_ITEMS or size + len(text or "") > BLOCK_BYTES):
            yield Block(block)
            block, size = [], 0
        block.append((i, found))
        size += len(text or "")
    if block:
        yield Block(block)


def _ranked(block: Block, src: DataFrame, sketches: DataFrame, k: int) -> DataFrame | None:
    """``(q, doc, score, rank)`` of one block, kept; None if no document holds a term."""
    spark = src.sparkSession
    documents, total = sketches.agg(F.count(F.lit(1)), F.sum("n")).first()
    # at most a row per term of the block
    df = arrow(src.select("text"), _counted(block), "term binary, df long").groupBy("term").agg(F.sum("df"))
    block.weigh({bytes(t): n for t, n in df.collect()}, documents, total)
    if not block.terms:
        return None
    queries = range(len(block.ids))

    def rescore(pairs: DataFrame) -> DataFrame:
        # kept, so that its size is known when the join with the texts is planned
        wanted = keep(pairs.groupBy("doc", "th").agg(F.collect_set("q").alias("queries")))
        same = F.col("d.doc").eqNullSafe(F.col("w.doc")) & (F.col("d.th") == F.col("w.th"))
        both = src.alias("d").join(wanted.alias("w"), same).select("d.doc", "d.text", "w.queries")
        return arrow(both, _scored(block), "q int, doc long, score long")

    def threshold(best: DataFrame) -> np.ndarray:
        """The ``k``-th best score of each query so far; 1 while it has fewer."""
        out = np.ones(len(block.ids))
        for q, score in best.filter(F.col("rank") == k).select("q", "score").collect():
            out[q] = score
        return out

    first = keep(_top(arrow(sketches, _best(block, k), "q int, doc long, th long, bound long"), k, "bound"))
    lowest = floor = threshold(_top(rescore(first), k, "score"))
    top = floor.copy()
    for q, bound in first.filter("rank = 1").select("q", "bound").collect():
        top[q] = max(top[q], bound)
    step = np.maximum(np.ceil((top - lowest) / LEVELS), 1)

    reach = keep(arrow(sketches, _reaching(block, lowest, step),
                       "q int, doc long, th long, bound long, level int"))
    size = np.zeros((len(block.ids), LEVELS), np.int64)
    for q, level, n in reach.groupBy("q", "level").agg(F.count(F.lit(1))).collect():
        size[q, level] = n
    best, done, wave = None, [LEVELS] * len(block.ids), WAVE
    while True:
        todo = []
        for q in queries:
            taken, to = 0, done[q]
            # a level below the last ends before the next one's lowest bound
            while to and taken < wave and (to == LEVELS or lowest[q] + to * step[q] > floor[q]):
                to -= 1
                taken += int(size[q, to])
            if taken:
                todo.append((q, to, done[q], int(floor[q])))
            done[q] = to
        if not todo:
            break
        part = spark.createDataFrame(todo, "q int, low int, high int, least long")       # a row per query
        rows = (reach.join(F.broadcast(part), "q")
                .filter((F.col("level") >= F.col("low")) & (F.col("level") < F.col("high"))
                        & (F.col("bound") >= F.col("least"))))
        more = rescore(rows.select("q", "doc", "th"))
        best = keep(_top(more if best is None else best.select("q", "doc", "score").unionByName(more), k, "score"))
        floor = threshold(best)
        wave *= GROWTH
    return best


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score
    above 0 for each row of ``items``, all if there are fewer; equal scores by
    rising document id, null ids last.

    A row of ``docs`` is a document of its own, whatever its id: repeated rows
    take a rank each. A null or empty text holds no term and is never found;
    an item without text or without any term that a document holds gives no
    row; repeated items give their rows each; very long texts are read whole;
    empty tables give none. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                      F.xxhash64(text_col).alias("th")).filter("text is not null")
    sketches = keep(max_sketches(src), compression="zstd")
    schema = f"q int, item_id {items.schema[item_col].dataType.simpleString()}"
    out = None
    for block in _blocks(items.select(item_col, query_col)):
        best = _ranked(block, src, sketches, k)
        if best is not None:
            names = spark.createDataFrame(list(enumerate(block.ids)), schema)      # a row per query
            found = best.join(F.broadcast(names), "q").select(
                "item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")
            out = found if out is None else out.unionByName(found)
    empty = spark.createDataFrame([], f"{schema.split(', ')[1]}, rank int, doc_id long, score long")
    return empty if out is None else out
