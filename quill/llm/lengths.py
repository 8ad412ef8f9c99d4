"""Exact token totals for every context limit, from one histogram of lengths.

Documents are encoded once and aggregated by encoded length (each task sums
its own documents first). Suffix sums over the lengths then answer, for any
limit: how many documents and tokens lie above it, how many tokens remain if
every document is truncated there, and every quantile, all exactly.

Suffix sums are taken in two levels (blocks of lengths, then inside a block),
so no task holds the histogram, however many lengths there are.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep
from quill.llm.tokens import VOCABULARY, Encoder

BLOCK = 4096     # lengths per block


def _counted(vocabulary: str):
    def run(batches):
        enc, n = Encoder(vocabulary), Counter()
        for b in batches:
            n.update(len(enc.ids(t)) for t in b.column(0).to_pylist())
            if len(n) > 100_000:
                yield _rows(n)
                n = Counter()
        yield _rows(n)
    return run


def _rows(n: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.int64()), pa.array(n.values(), pa.int64())],
                                      ["length", "n"])


def histogram(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``(length, n)``: documents per encoded length (kept). Null and empty
    texts have length 0; repeated rows count each time."""
    part = arrow(docs.select(text_col), _counted(vocabulary), "length long, n long")
    return keep(part.groupBy("length").agg(F.sum("n").alias("n")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length: documents and tokens of that length, of it and above, and the
    corpus size if every document is truncated to it."""
    h = hist.select("length", "n", F.floor(F.col("length") / BLOCK).alias("block"))
    tokens = F.col("length") * F.col("n")
    blocks = h.groupBy("block").agg(F.sum("n").alias("bn"), F.sum(tokens).alias("bt"))
    # one row per BLOCK lengths
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    above = blocks.select("block", F.coalesce(F.sum("bn").over(later), F.lit(0)).alias("an"),
                          F.coalesce(F.sum("bt").over(later), F.lit(0)).alias("at"),
                          F.sum("bn").over(Window.partitionBy()).alias("total_docs"),
                          F.sum("bt").over(Window.partitionBy()).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    return (h.join(above, "block")
            .withColumn("docs_from", F.col("an") + F.sum("n").over(inside))
            .withColumn("tokens_from", F.col("at") + F.sum(tokens).over(inside))
            .select("length", F.col("n").alias("docs"), tokens.alias("tokens"), "docs_from", "tokens_from",
                    (F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from"))
                    .alias("tokens_truncated"), "total_docs", "total_tokens"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Corpus tokens if every document is cut to ``limit`` (any limit: between two
    lengths the total grows by the documents above)."""
    r = (sums.filter(F.col("length") >= limit)
         .agg(F.max("docs_from").alias("d"), F.max("tokens_from").alias("t")).first())
    whole = sums.agg(F.max("total_tokens")).first()[0] or 0
    return whole - (r["t"] or 0) + limit * (r["d"] or 0)


def quantile(sums: DataFrame, q: float) -> int | None:
    """Smallest length that a share ``q`` of the documents does not exceed."""
    r = sums.filter((F.col("total_docs") - F.col("docs_from") + F.col("docs")) >= q * F.col("total_docs"))
    return r.agg(F.min("length")).first()[0]


def length_table(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The whole table of ``suffix_sums``. An empty corpus gives no row. Other
    columns are ignored, whatever their names."""
    return suffix_sums(histogram(docs, text_col, vocabulary))
