"""Fuzzy line deduplication over a whole corpus.

1. one pass over the texts: every line's 128-bit hash and the band keys of
   its character-shingle signature (circulant MinHash, see ``neardup``);
2. equal lines collapse to their first occurrence (smallest document, then
   line number) in a partial aggregation: a line that is everywhere is one row;
3. lines sharing a band key are compared on their full shingle sets and
   linked at Jaccard >= 0.8 (see ``cluster``; nothing is capped), and a
   distributed union-find gives the components;
4. of each component the first occurrence stays; all others are cut.

Lines are compared lower-cased and without surrounding white space; blank
lines are left alone. The registered query and the pipeline let every other
line take part (``min_chars=EVERY``). A line shorter than a shingle is one
shingle, the whole line, so it has no near copy that is not an equal one: it
goes without a signature. Called without ``min_chars``, lines of fewer than
``MIN_CHARS`` code points stay. A pair at exactly 0.8 is missed with
probability (1 - 0.8^4)^8 = 1.5 %, at 0.85 with 0.3 %, at 0.9 with 0.02 %.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.cluster import buckets, clusters
from quill.llm.common import arrow, keep, keep_sized, sized
from quill.llm.neardup import Circulant, band_keys
from quill.llm.texts import mix

WIDTH, SHARE, WHOLE = 7, 80, 100
BANDS, ROWS = 8, 4
MIN_CHARS = 20       # default of the functions
EVERY = 1            # min_chars of the query and the pipeline: all lines but blank ones
LINE = ["h1", "h2"]   # a line's 128-bit hash
CHUNK = 1 << 14      # characters signed at once
STEP = 16            # rows whose minima are taken together
POSITIONS = 1 << 16  # universe of the two permutations (a small table stays in cache)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE32, _MIX32 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def canonical(line: str) -> str:
    return line.strip().lower()


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-character windows (at least one window)."""
    width = min(width, len(codes))
    h = codes[:len(codes) - width + 1].astype(np.uint64)
    for j in range(1, width):
        h = h * _BASE + codes[j:len(codes) - width + 1 + j]
    return mix(h)


def char_shingles(line: str, width: int = WIDTH) -> np.ndarray:
    """Distinct ``width``-character shingles of a canonical line, sorted."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.unique(windows(codes, width)) if len(codes) else np.zeros(0, np.uint64)


def all_shingles(lines: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of canonical lines, with repeats, and how many each line has."""
    size = np.array([len(x) for x in lines])
    if size.min() < width:       # not of lines that have a signature
        own = [char_shingles(x, width) for x in lines]
        return np.concatenate(own), np.array([len(x) for x in own])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.ones(len(codes), bool)       # windows that cross no line's end
    for k in range(1, width):
        inside[np.cumsum(size) - k] = False
    return windows(codes, width)[inside[:len(codes) - width + 1]], size - width + 1


def _spots(codes: np.ndarray, width: int) -> np.ndarray:
    """Positions (below ``POSITIONS``) of all ``width``-character windows: a light
    32-bit hash, since band keys only propose lines to compare."""
    m = len(codes) - width + 1
    h = codes[:m].copy()
    for j in range(1, width):
        np.multiply(h, _BASE32, out=h)
        np.add(h, codes[j:m + j], out=h)
    h ^= h >> np.uint32(15)
    h *= _MIX32
    return h >> np.uint32(16)


def signatures(lines: list[str], circ: Circulant, width: int) -> np.ndarray:
    """Signatures of canonical lines, each at least ``width`` long: one pass over
    their joined characters, windows that cross a line's end left out."""
    size = np.array([len(x) for x in lines])
    end = np.cumsum(size)
    out = []
    i = 0
    while i < len(lines):
        j = max(i + 1, int(np.searchsorted(end, end[i] - size[i] + CHUNK, "right")))
        codes = np.frombuffer("".join(lines[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32)
        spots = _spots(codes, width)
        if j - i == 1:           # a long line: in pieces
            got = [_least(circ.rows, spots[k:k + CHUNK], np.zeros(1, np.int64), np.array([len(spots[k:k + CHUNK])]))
                   for k in range(0, len(spots), CHUNK)]
            out.append(np.min(got, axis=0))
        else:
            out.append(_least(circ.rows, spots, end[i:j] - size[i:j] - end[i] + size[i], size[i:j] - width + 1))
        i = j
    return np.concatenate(out)


def _least(rows: np.ndarray, spots: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Column minima of the ``rows`` at ``size`` consecutive ``spots`` from each
    ``start``: ``STEP`` spots of a line at once, its last ones repeated to fill up
    (few long passes, not one a row)."""
    n = -(-size // STEP)
    first = np.cumsum(n) - n
    at = np.repeat(start - first * STEP, n) + np.arange(n.sum()) * STEP
    last = np.repeat(start + size - 1, n)
    out = rows.take(spots[at], axis=0)
    more = np.empty_like(out)
    for k in range(1, STEP):
        # "clip" never applies: it spares take() a copy of ``out``
        rows.take(spots[np.minimum(at + k, last)], axis=0, out=more, mode="clip")
        np.minimum(out, more, out=out)
    return np.minimum.reduceat(out, first, axis=0)


def _halves(digests: list[bytes]) -> np.ndarray:
    """128-bit hashes as two columns of 64 bits: fixed-width keys."""
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T.copy()


def _signed(width: int, min_chars: int, bands: int, rows: int, seed: int):
    def run(batches):
        circ = Circulant(bands * rows, seed, POSITIONS)
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = b.column(1).to_pylist()
            hashes = b.column(2).to_pylist()
            at = 0
            while at < len(texts):
                doc, th, no, n, lines, size = [], [], [], [], [], 0
                while at < len(texts) and size < 16 * CHUNK:
                    if texts[at]:
                        size += len(texts[at])
                        own: dict[str, int] = {}        # a document's line, once
                        for k, line in enumerate(texts[at].split("\n")):
                            line = canonical(line)
                            if len(line) >= min_chars:
                                j = own.setdefault(line, len(lines))
                                if j < len(lines):
                                    n[j] += 1
                                    continue
                                doc.append(ids[at])
                                th.append(hashes[at])
                                no.append(k)
                                n.append(1)
                                lines.append(line)
                    at += 1
                if not lines:
                    continue
                whole = [len(x) >= width for x in lines]
                keys = np.zeros((len(lines), bands), np.int64)
                if any(whole):
                    keys[whole] = band_keys(signatures([x for x in lines if len(x) >= width], circ, width),
                                            bands, rows)
                without = ~np.array(whole)
                digest = _halves([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[0]), pa.array(digest[1]), pa.array(doc, pa.int64()), pa.array(th, pa.int64()),
                     pa.array(no, pa.int32()), pa.array(n, pa.int64()), *[pa.array(keys[:, k], mask=without) for k in range(bands)]],
                    ["h1", "h2", "doc", "th", "no", "n", *[f"k{k}" for k in range(bands)]])
    return run


def _chosen(batches):
    """(text, ids, line numbers) -> (id, text of that line)."""
    for b in batches:
        ids, texts = [], []
        for text, own, nos in zip(*(b.column(k).to_pylist() for k in range(3))):
            lines = text.split("\n")
            ids += own
            texts += [canonical(lines[no]) for no in nos]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())],
                                         ["id", "text"])


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  width: int = WIDTH, min_chars: int = MIN_CHARS, bands: int = BANDS,
                  rows: int = ROWS, seed: int = 13) -> DataFrame:
    """``(doc, th, drop)``: the numbers (from 0) of the lines to cut, per document
    id and ``xxhash64`` of its text that has any. Kept (in the checkpoint folder)."""
    if min_chars < 1:
        raise ValueError("min_chars must be at least 1: blank lines stay")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(text_col).alias("th"))
    src = src.filter("id is not null and text is not null")
    ks = [f"k{k}" for k in range(bands)]
    found = arrow(src, _signed(width, min_chars, bands, rows, seed),
                  "h1 long, h2 long, doc long, th long, no int, n long, " + ", ".join(f"{k} long" for k in ks))
    # fixed-width columns: the aggregation hashes, it does not sort. Only where an
    # id has two rows does the smallest id alone not tell the first line
    once = (docs.select(F.col(id_col).cast("long").alias("id")).filter("id is not null")
            .groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty())
    if once:
        first = F.struct(F.min("doc").alias("doc"), F.min_by("th", "doc").alias("th"), F.min_by("no", "doc").alias("no"))
    else:
        first = F.min(F.struct("doc", "th", "no"))
    lines = keep(found.groupBy(*LINE).agg(
        first.alias("first"), F.sum("n").alias("n"), *[F.first(k).alias(k) for k in ks]).select(
        F.monotonically_increasing_id().alias("id"), *LINE, "first", "n",
        F.when(F.col("k0").isNotNull(), F.array(*ks)).alias("keys")),
        **{"parquet.enable.dictionary": "false"})     # hashes hardly repeat
    bucket = buckets(lines.select("id", "keys"))
    # all that is asked of the lines in buckets, found once
    items = keep(lines.select("id", *LINE, "first").join(bucket.select("id").distinct(), "id"))
    _, wanted, _ = keep_sized(items.groupBy(F.col("first.doc").alias("doc"), F.col("first.th").alias("th"))
                              .agg(F.collect_list(F.struct("id", F.col("first.no").alias("no"))).alias("wanted"))
                              .select(F.col("doc").alias("id"), "th", F.col("wanted.id").alias("ids"), F.col("wanted.no").alias("nos")), 72)
    texts = arrow(src.join(wanted, ["id", "th"]).select("text", "ids", "nos"), _chosen, "id long, text string")
    texts = keep(texts if once else texts.dropDuplicates(["id"]))

    low = clusters(bucket, texts, lambda line: char_shingles(line, width), SHARE, WHOLE,
                   most=len, shingles=lambda lines: all_shingles(lines, width))
    # of each component, the first occurrence stays
    member = low.unionByName(low.select(F.col("low").alias("id"), "low").distinct())
    member = items.join(member, "id")
    stays = keep(member.groupBy("low").agg(F.min("first").alias("stays")))
    fuzzy = keep(member.join(stays, "low").select(*LINE, "stays"))
    _, again, _ = keep_sized(lines.filter("n > 1").select(*LINE, "first")
                             .join(fuzzy, LINE, "left_anti").select(*LINE, F.col("first").alias("stays"))
                             .unionByName(fuzzy), 64)
    # occurrences come from a second, light pass: the first one carries the keys
    seen = arrow(src, _hashed(min_chars), "h1 long, h2 long, doc long, th long, no int")
    return keep(seen.join(again, LINE)
                .filter((F.col("doc") != F.col("stays.doc")) | (F.col("th") != F.col("stays.th"))
                        | (F.col("no") != F.col("stays.no")))
                .groupBy("doc", "th").agg(F.collect_set("no").alias("drop")))


def _hashed(min_chars: int):
    def run(batches):
        for b in batches:
            digest, doc, th, no = [], [], [], []
            for i, text, h in zip(*(b.column(k).to_pylist() for k in range(3))):
                for k, line in enumerate(text.split("\n")):
                    line = canonical(line)
                    if len(line) >= min_chars:
                        digest.append(xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass")))
                        doc.append(i)
                        th.append(h)
                        no.append(k)
            digest = _halves(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[0]), pa.array(digest[1]), pa.array(doc, pa.int64()), pa.array(th, pa.int64()),
                 pa.array(no, pa.int32())], ["h1", "h2", "doc", "th", "no"])
    return run


def _picked(lines, at):
    """The lines at these numbers as a text. The array is bound once: an expression
    inside a function over another array is evaluated for each of its elements."""
    one = F.transform(F.array(lines), lambda own: F.array_join(F.transform(at, lambda k: F.get(own, k)), "\n"))
    return F.get(one, F.lit(0))


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs``, ``text_col`` without its repeated lines, plus
    ``(n_lines, n_cut)``, which replace columns of these names."""
    drop = dropped_lines(docs, id_col, text_col, **options)
    drop = drop.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("drop").alias("_drop"))
    cols = [c for c in docs.columns if c not in ("n_lines", "n_cut")]
    text = F.col(text_col)
    same = (F.col(id_col).cast("long") == F.col("_doc")) & (F.xxhash64(text) == F.col("_th"))
    out = docs.select(*cols).join(sized(drop, 48), same, "left")
    # no text is split just to count its lines
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int")
    cut = F.col("_drop").isNotNull() & (text != "")
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("_drop"))
    left = _picked(F.split(text, "\n", -1), stay)
    return out.select(*[F.when(cut, left).otherwise(text).alias(c) if c == text_col else F.col(c) for c in cols],
                      F.when(text != "", n_lines).otherwise(0).cast("long").alias("n_lines"),
                      F.when(cut, F.size("_drop")).otherwise(0).cast("long").alias("n_cut"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``(doc_id, text, n_lines, n_cut)``, the text without
    the lines that repeat an earlier one, exactly or nearly.

    Null texts stay null and empty ones empty (0 lines); a text of which every
    line is cut becomes empty. Rows with a null id pass unchanged. Rows that
    repeat an id and its text are the same document and lose the same lines;
    rows of one id with other texts are documents of their own. Among ties the
    smallest document id, then the first line stays. Other columns are
    ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut_lines(src, **options).select("doc_id", "text", "n_lines", "n_cut")
