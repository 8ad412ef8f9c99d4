"""Best-fit packing of token pieces into sequences of fixed capacity.

Bulk-synchronous best fit, decreasing:

1. documents are encoded and cut into pieces of at most ``capacity`` tokens;
   the table of pieces (ids, lengths, checksums; no tokens) is kept;
2. pieces are sorted by length: a piece's place in that order is its length
   and its rank among the pieces of the length. Pieces of one length are
   interchangeable, so sorted pieces and sorted gaps are held as runs
   (length or gap, count): a table bounded by the capacity, not by the corpus;
3. one superstep per length, longest first: all its pieces look up their
   successor, the smallest gap that holds them; the gap's sequences go to the
   first ranks, later ranks sweep on to the next gap, what finds none opens
   sequences; the gaps are updated, and the next length follows;
4. every piece finds its run by (length, rank) and from it its sequence and
   offset, in parallel.

The result equals sequential best-fit-decreasing. Ranks are counted within
(length, hash) cells, so a length that a third of all pieces share is spread
over as many tasks as the session has shuffle partitions.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep
from quill.llm.tokens import VOCABULARY, Encoder

CAPACITY, END_ID = 1024, 2
_SHIFT = 48     # length << 48 | rank


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; the first may be shorter."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, count, first sequence, offset)`` that place
    ``counts[length]`` pieces: the ranks of a run go to consecutive sequences."""
    runs, opened = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}     # gap -> [(first sequence, count)]
    order: list[int] = []                           # gaps that some sequence has, ascending

    def free(gap: int, seq: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((seq, count))

    for length in sorted(counts, reverse=True):
        rank, need = 0, counts[length]

        def fill(gap: int, seq: int, count: int, each: int) -> None:
            """``each`` pieces into every one of ``count`` sequences with this gap."""
            nonlocal rank, need
            for j in range(each if count else 0):
                runs.append((length, rank, count, seq, capacity - gap + j * length))
                rank += count
            need -= each * count
            free(gap - each * length, seq, count)

        while need:
            at = bisect_left(order, length)         # successor sweep
            if at < len(order):
                gap = order[at]
                seq, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, seq = capacity, opened
                count = -(-need // (capacity // length))
                opened += count
            each = gap // length
            whole = min(count, need // each)
            left = min(need - whole * each, each) if whole < count else 0
            fill(gap, seq, whole, each)
            if left:
                fill(gap, seq + whole, 1, left)
            used = whole + (1 if left else 0)
            free(gap, seq + used, count - used)
    return runs


def _cut(capacity: int, end_id: int, vocabulary: str):
    def run(batches):
        enc = Encoder(vocabulary)
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = array("I", enc.ids(text))
                ids.append(end_id)
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    doc.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32())]
                + [pa.array(v, pa.int64()) for v in (start, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document's ids and the end id, cut to ``capacity``."""
    return arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)),
                 _cut(capacity, end_id, vocabulary),
                 "doc_id long, piece int, start long, length long, ids_crc32 long")


def _placed(runs: list[tuple[int, int, int, int, int]]):
    runs = sorted(runs)
    key = np.array([(r[0] << _SHIFT) + r[1] for r in runs], np.int64)
    rank0, seq0, off = (np.array([r[k] for r in runs], np.int64) for k in (1, 3, 4))

    def run(batches):
        for b in batches:
            rank = b.column(5).to_numpy()
            at = np.searchsorted(key, (b.column(3).to_numpy() << _SHIFT) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(seq0[at] + rank - rank0[at]), pa.array(off[at])],
                [*b.schema.names[:5], "sequence_id", "offset"])
    return run


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence exceeds ``capacity``."""
    cuts = keep(cuts)
    spark = cuts.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cuts.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    per_cell = cells.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in                      # at most ``capacity`` rows
              per_cell.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    base = per_cell.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cells.withColumn("pos", F.row_number().over(inside) - 1).join(base, ["length", "cell"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("base") + F.col("pos")).alias("rank")))
    return arrow(ranked, _placed(best_fit(counts, capacity)),
                 "doc_id long, piece int, start long, length long, ids_crc32 long, "
                 "sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id,
    offset)``.

    Null and empty texts are one piece holding the end id alone. A null id
    stays null. Rows that repeat an id are packed each. Pieces of equal length
    are ranked by hash cell, then id, piece and checksum. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    return pack(pieces(docs, id_col, text_col, capacity, end_id, vocabulary), capacity)
