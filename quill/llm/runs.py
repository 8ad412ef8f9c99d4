"""Periodic runs of words: maximal stretches that repeat four times and more.

Internal pattern matching over the words of a batch of documents, all of it in
arrays. A run of smallest period q with ``2^k <= q < 2^(k+1)`` holds a dyadic
block (start a multiple of ``2^k``, length ``2^k``) in its first two periods,
and that block recurs q words later, in the window that follows it:

1. a suffix array by prefix doubling; which round split two neighbours gives the
   class of every block of ``2^k`` words as an interval of the array;
2. a wavelet matrix over the suffix array answers range successor: the next
   occurrences of a block in its window, at each level k for all blocks at once;
3. one or two occurrences are candidate periods themselves. Three or more form
   a progression whose difference is the block's own period d; a run with a
   larger period must break the two d-periodic stretches alike, so only the
   differences of their starts and of their ends are candidates;
4. a candidate period is extended both ways by longest common extensions over
   the same classes. Equal stretches keep their smallest period.

Words are numbered per document, so nothing matches across documents.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow

TIMES, LEAST = 4, 6        # a run's length is at least LEAST words and TIMES periods
BATCH_WORDS = 1 << 16      # documents are gathered up to this many words
FIELDS = ("start", "length", "period")


class Suffixes:
    """Suffix array of ``x`` and the classes of its blocks of ``2^k`` words."""

    def __init__(self, x: np.ndarray):
        n = self.n = len(x)
        order = np.argsort(x, kind="stable")
        split = np.full(n, 127, np.int8)            # first k whose classes part slot - 1 and slot
        split[0] = 0
        split[1:][x[order[1:]] != x[order[:-1]]] = 0
        rank = np.empty(n + 1, np.int64)
        rank[n] = -1
        slot = np.arange(n)
        rank[order] = np.maximum.accumulate(np.where(split == 0, slot, 0))
        k, active = 0, self._shared(split < 127, slot)
        while len(active):
            at = order[active]
            key = rank[at] << 32 | rank[np.minimum(at + (1 << k), n)] + 1
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[active] = at
            k += 1
            new = np.zeros(len(active), bool)
            new[1:] = (key[1:] != key[:-1]) & (split[active[1:]] == 127)
            split[active[new]] = k
            first = split[active] < 127
            rank[at] = np.maximum.accumulate(np.where(first, active, 0))
            active = active[self._shared(first, np.arange(len(active)))]
        self.order, self.split, self.levels = order, split, k

    @staticmethod
    def _shared(first: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Those that are in a class of two or more (``first`` marks class starts)."""
        last = np.append(first[1:], True)
        return index[~(first & last)]

    def intervals(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Per slot, its class of ``2^k`` words: first slot and one beyond the last."""
        first = np.flatnonzero(self.split <= k)
        size = np.diff(np.append(first, self.n))
        return np.repeat(first, size), np.repeat(first + size, size)

    def classes(self, k: int) -> np.ndarray:
        """Per position, its class of ``2^k`` words; -1 beyond the end."""
        out = np.full(self.n + 1, -1, np.int64)
        out[self.order] = self.intervals(k)[0]
        return out

    def extensions(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree from ``i`` and ``j`` on, and before them (``i < j``)."""
        on, back = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for k in range(self.levels - 1, -1, -1) if len(i) else ():
            c, step = self.classes(k), 1 << k
            on += step * (c[i + on] == c[j + on])
            u, v = i - back - step, j - back - step
            back += step * ((u >= 0) & (c[np.maximum(u, 0)] == c[np.maximum(v, 0)]))
        return on, back


class Wavelet:
    """Wavelet matrix over a permutation: successors of values in slot ranges."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values) - 1).bit_length(), 1)
        self.zeros, self.none = [], len(values)
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]))
            values = np.concatenate([values[low], values[~low]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least ``least`` in the slots ``[lo, hi)``, or ``none``."""
        a, b, nth = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for z, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):    # how many are smaller
            one = (least >> bit & 1) == 1
            za, zb = z[a], z[b]
            nth += np.where(one, zb - za, 0)
            a, b = np.where(one, z[-1] + a - za, za), np.where(one, z[-1] + b - zb, zb)
        beyond = least >= 1 << self.bits
        found = (nth < hi - lo) & ~beyond
        a, b, nth = lo.copy(), hi.copy(), np.where(found, nth, 0)
        out = np.zeros(len(lo), np.int64)
        for z, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):    # the nth smallest
            za, zb = z[a], z[b]
            one = nth >= zb - za
            nth -= np.where(one, zb - za, 0)
            out |= one.astype(np.int64) << bit
            a, b = np.where(one, z[-1] + a - za, za), np.where(one, z[-1] + b - zb, zb)
        return np.where(found, out, self.none)


def _candidates(s: Suffixes, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(block start, candidate period)`` of all levels."""
    starts, periods, chains = [], [], []
    wavelet = None
    slot_of = np.empty(s.n, np.int64)
    slot_of[s.order] = np.arange(s.n)
    for k in range(longest.bit_length()):
        step = 1 << k
        if TIMES * step > longest or k > s.levels:
            break
        lo, hi = s.intervals(k)
        b = np.arange(0, s.n - 2 * step + 1, step)
        at = slot_of[b]
        # within a run a block occurs at least three times
        some = hi[at] - lo[at] >= TIMES - 1
        b, at = b[some], at[some]
        if not len(b):
            continue
        if k == 0:           # the window of a single word is the next word
            b = b[lo[at] == lo[slot_of[b + 1]]]
            starts.append(b)
            periods.append(np.ones(len(b), np.int64))
            continue
        if wavelet is None:
            wavelet = Wavelet(s.order)
        lo, hi, end = lo[at], hi[at], b + 2 * step
        one = wavelet.successor(lo, hi, b + step)
        hit = one < end
        b, lo, hi, end, one = b[hit], lo[hit], hi[hit], end[hit], one[hit]
        two = wavelet.successor(lo, hi, one + 1)
        more = two < end
        three = np.full(len(b), s.n)
        three[more] = wavelet.successor(lo[more], hi[more], two[more] + 1)
        chain = more & (three < end)
        pair = more & ~chain
        starts += [b[~chain], b[pair]]
        periods += [one[~chain] - b[~chain], two[pair] - b[pair]]
        chains.append(np.stack([b[chain], one[chain], two[chain] - one[chain]]))
    if chains and sum(c.shape[1] for c in chains):
        b, one, d = np.concatenate(chains, axis=1)
        on, back = s.extensions(np.concatenate([b, one]), np.concatenate([b + d, one + d]))
        m = len(b)
        ends = (one + on[m:]) - (b + on[:m])
        begins = (one - back[m:]) - (b - back[:m])
        for q in (ends, begins):
            starts.append(b[q > 0])
            periods.append(q[q > 0])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    fits = both[0] + both[1] < s.n
    return both[0][fits], both[1][fits]


def find_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``(start, length, period)`` sorted by start, then period, for documents
    of at most ``longest`` words joined in ``x``; no two share a word's number."""
    none = np.zeros((0, 3), np.int64)
    if longest < LEAST:
        return none
    s = Suffixes(x)
    b, q = _candidates(s, longest)
    on, back = s.extensions(b, b + q)
    start, length = b - back, back + q + on
    fits = length >= np.maximum(LEAST, TIMES * q)
    rows = np.stack([start[fits], length[fits], q[fits]], axis=1)
    if not len(rows):
        return none
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
    rows = rows[first]                   # the smallest period of a stretch
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, as UTF-8."""
    return text.encode("utf-8").split() if text else []


def tail_repeated(doc_id: int | None, found: list[bytes]) -> list[bytes]:
    """The words with the repeated tail that the contract gives a tenth of all ids."""
    n = len(found)
    if doc_id is None or not n:
        return found
    h = zlib.crc32(str(doc_id).encode("ascii"))
    if h % 10:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = found[a:a + p]
    return found[:a] + (unit * ((n - a) // p + 1))[:n - a]


def _gathered(batches, change):
    """Documents ``(id, words)`` in groups of about ``BATCH_WORDS`` words."""
    group, size = [], 0
    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1)):
            found = words(text.as_py())
            if change:
                found = tail_repeated(i, found)
            group.append((i, found))
            size += len(found)
            if size >= BATCH_WORDS:
                yield group
                group, size = [], 0
    if group:
        yield group


def _group_runs(group) -> list[list[tuple[int, int, int]]]:
    """Per document its runs ``(start, length, period)``, starts counted within it."""
    x, ends, base = [], [], 0
    for _, found in group:
        number: dict[bytes, int] = {}
        x.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)) + base)
        base += len(number)
        ends.append(len(found))
    longest = max(ends)
    ends = np.cumsum(ends)
    rows = find_runs(np.concatenate(x), longest)
    cut = np.searchsorted(rows[:, 0], ends)
    out, at = [], 0
    for begin, to in zip(np.concatenate([[0], ends[:-1]]).tolist(), cut.tolist()):
        out.append([(a - begin, m, q) for a, m, q in rows[at:to].tolist()])
        at = to
    return out


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, each run cut back to its first period, joined by one space."""
    if not runs:
        return b" ".join(found)
    drop = np.zeros(len(found) + 1, np.int64)
    for a, m, q in runs:
        drop[a + q] += 1
        drop[a + m] -= 1
    return b" ".join(found[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist())


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Greatest exact length / period; ties: smallest start, then period."""
    best = None
    for a, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (a, m, q)
    return best


def _digests(change: bool):
    def run(batches):
        for group in _gathered(batches, change):
            out: list[list] = [[] for _ in range(8)]
            for (i, found), runs in zip(group, _group_runs(group)):
                best = strongest(runs)
                listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
                row = [i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                       hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(found, runs)).hexdigest()]
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out[:6]] + [pa.array(c, pa.string()) for c in out[6:]],
                ["doc_id", "n_runs", *FIELDS, "exponent_milli", "runs_sha256", "collapsed_sha256"])
    return run


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                repeat_tails: bool = False) -> DataFrame:
    """One row per document: ``(doc_id, n_runs, start, length, period,
    exponent_milli, runs_sha256, collapsed_sha256)``.

    The named run is the one of greatest length / period, ties going to the
    smallest start, then period. A null or empty text has no word and no run
    (four nulls, digests of nothing); a null id keeps its row and, with
    ``repeat_tails``, its words; repeated rows give equal rows; an empty table
    gives none. A task holds one text at a time, or several short ones. Other
    columns are ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow(src, _digests(repeat_tails),
                 "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                 "runs_sha256 string, collapsed_sha256 string")


def _rows(batches):
    for group in _gathered(batches, False):
        ids, runs, texts = [], [], []
        for (i, found), own in zip(group, _group_runs(group)):
            ids.append(i)
            runs.append([dict(zip(FIELDS, r)) for r in own])
            texts.append(collapsed(found, own).decode("utf-8"))
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in FIELDS]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
                                         ["doc_id", "runs", "text"])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, runs, text)``: every run of a document as ``(start, length,
    period)`` in words, and its words with each run cut back to one period,
    joined by one space. Nulls and empties as in ``run_digests``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow(src, _rows, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string")
