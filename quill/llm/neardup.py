"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard.

Method (circulant MinHash): a text's word shingles fall on positions of a
fixed universe. One permutation ``sigma`` scatters the positions once; a
second, ``pi``, gives hash values, and signature coordinate ``k`` uses ``pi``
circularly shifted by ``k``. The shifted values of one shingle are a
contiguous slice of ``pi``, so a signature is one gather and a minimum.

1. one pass over the texts: set size, fingerprint of the full set, band keys;
2. equal sets form a class, represented by its smallest id (copies are never
   paired);
3. representatives sharing a band key are compared on the full sets of their
   texts, star by star and, where components still meet, block by block (see
   ``cluster``), and linked ones are merged into components.

No bucket is capped. A pair at exactly the threshold is missed with
probability (1 - 0.75^5)^40 = 2e-5, a closer pair with less. Sets are
compared by 64-bit shingle hashes, classes by 128-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.cluster import buckets, clusters
from quill.llm.common import arrow, keep, keep_sized
from quill.llm.texts import mix, word_shingles

WORDS, SHARE, WHOLE = 5, 75, 100     # link if 100 * intersection >= 75 * union
BANDS, ROWS = 40, 5
POSITIONS = 1 << 20                  # universe of the two permutations


class Circulant:
    """Signatures of ``coords`` coordinates from two permutations."""

    def __init__(self, coords: int, seed: int = 11, positions: int = POSITIONS):
        rng = np.random.default_rng(seed)
        self.positions = positions
        self.sigma = rng.permutation(positions)
        pi = rng.permutation(positions).astype(np.uint16 if positions <= 1 << 16 else np.uint32)
        self.shifts = np.lib.stride_tricks.sliding_window_view(
            np.concatenate([pi, pi[:coords]]), coords)

    @cached_property
    def rows(self) -> np.ndarray:
        """``shifts`` by place before ``sigma``, for a small universe: one gather, of whole rows."""
        return self.shifts[self.sigma]

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return self.sigma[(hashes % np.uint64(self.positions)).astype(np.int64)]

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        out = self.shifts[at[:4096]].min(axis=0)
        for i in range(4096, len(at), 4096):     # very long texts: bounded memory
            out = np.minimum(out, self.shifts[at[i:i + 4096]].min(axis=0))
        return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit bucket keys, one per band (the band's number is part of the key)."""
    s = sig.reshape(sig.shape[:-1] + (bands, rows)).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        key = mix(key + s[..., j])
    return key.view(np.int64)


def _signed(words: int, bands: int, rows: int, seed: int):
    def run(batches):
        circ = Circulant(bands * rows, seed)
        for b in batches:
            n, fp, keys = [], [], []
            for text in b.column(1).to_pylist():
                s = word_shingles(text, words)
                n.append(len(s))
                if len(s):
                    fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    keys.append(band_keys(circ.signature(s), bands, rows))
                else:
                    fp.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "fp", "keys"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, bands: int = BANDS, rows: int = ROWS,
                    seed: int = 11) -> DataFrame:
    """One row per input row: ``(doc_id, n_shingles, component_id, kept)``.

    Null and empty texts and texts without words have no shingle, are linked
    with nothing and are kept; a null id is its own document (component null,
    kept). Rows repeating an id are one document and get the same component.
    Other columns are ignored, whatever their names. An empty table gives an
    empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = keep(arrow(src, _signed(words, bands, rows, seed),
                     "id long, n long, fp binary, keys array<long>"))
    same = keep(sig.filter("n > 0 and id is not null").groupBy("fp")
                .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
                .filter("m > 1").select("fp", "rep"))
    member = (sig.filter("n > 0 and id is not null").join(same, "fp", "left")
              .select("id", "n", "keys", F.coalesce("rep", "id").alias("rep")))
    reps = keep(member.filter("id = rep").select("id", "n", "keys"))

    bucket = buckets(reps.select("id", "keys"))
    _, ids, _ = keep_sized(bucket.select("id").distinct())
    texts = keep(src.join(ids, "id", "left_semi").dropDuplicates(["id"]))
    low = (clusters(bucket, texts, lambda text: word_shingles(text, words), SHARE, WHOLE)
           .withColumnRenamed("id", "rep"))
    rep_of = sig.join(same, "fp", "left").select(
        "id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("rep", "id"))
        .otherwise(F.col("id")).alias("rep"))
    return (rep_of.join(low, "rep", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("low", "rep").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the document
    with the smallest id stays, once if rows repeat that id."""
    found = keep(near_duplicates(docs, id_col, text_col, **options).select("doc_id", "kept"))
    _, gone, _ = keep_sized(found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct())
    out = docs.join(gone, F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
    _, again, n = keep_sized(found.filter("kept and doc_id is not null").groupBy("doc_id")
                             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again")))
    if not n:
        return out
    is_again = F.col(id_col).cast("long") == F.col("_again")
    once = out.join(again, is_again, "left_semi").dropDuplicates([id_col])
    return out.join(again, is_again, "left_anti").unionByName(once)
