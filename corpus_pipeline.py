"""Corpus pipeline: quality rules, line dedup, near-dedup, source mixing, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, written as Parquet and reread as the next
stage's ``docs``. All but the last return the columns of ``documents``.

For every stage: a null text is an empty one to the rules and stays null where
the document stays; very long texts are read whole; rows that repeat an id and
text are one document to line and near dedup; of equal claims the smallest
document id stays; an empty table gives an empty one; columns beyond those of
``documents`` pass through, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.llm.common import keep, table
from quill.llm.lines import EVERY, cut_lines
from quill.llm.mixing import mix
from quill.llm.neardup import keep_one, near_duplicates
from quill.llm.packing import pack_documents
from quill.llm.quality import keep_good
from quill.llm.queries import REST, WEIGHTS
from quill.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are cut from the texts (``n_chars`` follows); a document of
    which no word is left goes, since all it said stays elsewhere."""
    out = cut_lines(docs, min_chars=EVERY).filter((F.col("n_cut") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_cut") > 0, size).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    The stage before cuts the lines that copies share, and so hides them: what
    is left of a near copy is the few lines that differ. Groups are therefore
    found first on the whole texts of the documents that are still there, as
    the table ``documents`` holds them (same id, language and source), then
    among the texts as they are now. Only a document whose like stays goes.
    Documents with a null id, or that the table does not hold, are judged by
    their present text alone.
    """
    same = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    here = docs.select(*[F.col(c).alias(f"_{c}") for c in same]).distinct()
    is_here = F.col("doc_id") == F.col("_doc_id")
    for c in same[1:]:
        is_here = is_here & F.col(c).eqNullSafe(F.col(f"_{c}"))
    whole = table(spark, sf_dir, "documents").select(*same, "text").join(here, is_here, "left_semi")
    found = near_duplicates(whole.select("doc_id", "text"))
    gone = keep(found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct())
    left = docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    return keep_one(left)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, globally shuffled."""
    return mix(docs, WEIGHTS, REST).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: MinHash, exact binomial bounds and best-fit packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and reread."""
    root = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{root}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
