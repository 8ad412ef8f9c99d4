"""Lookup-oriented table layouts: the re-aim of the reference's indexes.

A B-tree index makes a selective lookup skip most of the table. On Parquet
the same effect comes from layout: partition folders for low-cardinality
keys (a year), and for high-cardinality keys a materialised key column with
files sorted on it, so each row group's min/max statistics let the reader
skip every group that cannot match. A function index (``UPPER(col)``)
becomes a stored column holding that function's value, because a filter on
a function of a column cannot be pushed into the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.functions._col import as_col
from quill.sources.sinks import TableStore


def partitioned_by(store: TableStore, df: DataFrame, name: str, part_col: str, part_expr: Column,
                   sort_within: list[str], files: int = 8) -> DataFrame:
    """Write ``df`` with a derived partition column (e.g. the year of a date).

    Rows are dealt by partition value and one of ``files`` hash slots first, so
    a folder gets at most ``files`` files, not one per task, and a value that
    holds a third of the rows is still written by several tasks."""
    slot = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    dealt = df.withColumn(part_col, part_expr).repartition(F.col(part_col), slot)
    return store.create_as(dealt, name, partition_by=[part_col], sort_within=sort_within)


def clustered_by(store: TableStore, df: DataFrame, name: str, cols: list[str],
                 partitions: int | None = None) -> DataFrame:
    """Write ``df`` range-clustered and sorted on several columns (the re-aim of
    an index on them): a filter on a leading part of ``cols`` skips files."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[F.col(c) for c in cols], F.xxhash64(*df.columns))
    return store.create_as(dealt, name, sort_within=cols)


def catalog_name(spark, name: str) -> str:
    """``name`` with the application's id: applications that share a metastore do
    not replace each other's tables."""
    return f"{name}_{re.sub('[^0-9A-Za-z]', '_', spark.sparkContext.applicationId)}"


def bucketed_by(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Save ``df`` as table ``name`` bucketed and sorted on a join key: a join or
    aggregation on it reads the buckets without a shuffle on this side. Built
    once, read many times; rows are dealt by key first, one file per bucket."""
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def keyed_by(store: TableStore, df: DataFrame, name: str, key_col: str, key_expr: Column,
             partitions: int | None = None) -> DataFrame:
    """Write ``df`` with a stored lookup key (e.g. ``upper(name)``), range-
    clustered and sorted on it, so equality on the key is pushed down and
    files / row groups outside the key's range are skipped.

    The range partitioning also sorts on a row hash after the key, so a key
    shared by a large share of the rows is split over several files instead
    of landing in one task."""
    keyed = df.withColumn(key_col, key_expr)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(c) for c in keyed.columns])
    clustered = keyed.repartitionByRange(n, F.col(key_col), tie)
    return store.create_as(clustered, name, sort_within=[key_col])


def words_of(text) -> Column:
    """Distinct words of a text: runs of letters and digits, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(as_col(text)), F.lit(r"([\p{L}\p{N}]+)"), 1))


def inverted_by_word(store: TableStore, df: DataFrame, name: str, key: str, text: str,
                     partitions: int | None = None) -> DataFrame:
    """Write the table ``(word, <key>)`` of all words of ``text``, range-clustered and
    sorted by word: the rows whose word starts with a prefix lie together, so
    ``LIKE '%Prefix%'`` over words becomes a pushed prefix filter that skips all
    other row groups. A word of very many rows is split over several files by
    its key."""
    words = df.select(F.explode(words_of(text)).alias("word"), F.col(key))
    return clustered_by(store, words, name, ["word", key], partitions)


def with_word_starting(df: DataFrame, inverted: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows of ``df`` with a word that starts with ``prefix`` (letters and digits),
    found in its inverted table; each row once."""
    if not prefix.isalnum():
        raise ValueError("a word prefix is letters and digits")
    return df.join(inverted.filter(F.col("word").startswith(prefix.lower())).select(key), key, "left_semi")
