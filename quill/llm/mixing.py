"""Mixing sources to target weights by Poisson replication.

A document of source ``s`` is repeated ``N ~ Poisson(rate_s)`` times, where
``rate_s = weight_s * total / size_s`` makes the expected size of every source
the asked share of the total. The draw inverts the Poisson distribution at a
uniform number taken from a hash of the seed and the document's id, so it is
reproducible, needs no state and is the same however the table is split.

Sizes are code points of whole texts. Weights are given for named sources;
``rest`` is the weight of all other sources together (null included), so the
table of rates has one row more than ``weights`` at most, whatever the corpus
holds, and is broadcast. Copies get random keys and are dealt out by them: a
document's place (partition, order in it) is a uniform shuffle of the whole
table, without range sampling and without a hot source meeting in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 20
MAX_RATE = 512.0     # a larger rate is the sum of equal draws below it: exp(-rate) must not vanish
_REST = "rest of sources"


def uniform(seed: int, salt: str, *cols: Column) -> Column:
    """Uniform in [0, 1): 52 bits of the MD5 of seed, salt and columns."""
    text = F.concat_ws(":", F.lit(f"{seed}:{salt}"),
                       *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_cdf(rate: float) -> list[float]:
    """P(N <= 0), P(N <= 1), ... up to where the rest is below 2^-53."""
    p = total = math.exp(-rate)
    out, k = [total], 0
    while k < rate or p > 2.0 ** -60:
        k += 1
        p *= rate / k
        total += p
        out.append(min(total, 1.0))
    return out


def rates(docs: DataFrame, weights: dict[str, float], rest: float = 0.0,
          source_col: str = "source", text_col: str = "text") -> list[tuple[str, float]]:
    """Mean repetition per named source and for the rest (one aggregation)."""
    group = _group(F.col(source_col), weights)
    size = {r["g"]: r["size"] for r in docs.groupBy(group.alias("g")).agg(
        F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("size")).collect()}
    asked = {**weights, _REST: rest}
    whole, total = sum(asked.values()), sum(size.values())
    if whole <= 0 or any(w < 0 for w in asked.values()):
        raise ValueError("weights must not be negative and must not all be zero")
    out = []
    for g, w in asked.items():
        out.append((g, w / whole * total / size[g] if size.get(g) else (1.0 if w else 0.0)))
    return out


def _group(source: Column, weights: dict[str, float]) -> Column:
    return F.when(source.isin(*weights), source).otherwise(F.lit(_REST)) if weights else F.lit(_REST)


def mix(docs: DataFrame, weights: dict[str, float], rest: float = 0.0, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """The input rows, each as often as drawn, in globally shuffled order, plus
    ``copy`` (0, 1, ...) and ``shuffle_key`` (the order within a partition).

    Null and empty texts have size 0 and are drawn like others of their
    source; a source without any text has rate 1 if it has a weight. A null
    source belongs to the rest, a null id draws as the word "null". Rows that
    repeat an id draw the same count. A column of the input that is named like
    one of the two new columns is replaced. An empty table stays empty.
    """
    table = rates(docs, weights, rest, source_col, text_col)
    spark = docs.sparkSession
    parts = [max(1, math.ceil(r / MAX_RATE)) for _, r in table]
    cdf = F.broadcast(spark.createDataFrame(
        [(g, poisson_cdf(r / k), k) for (g, r), k in zip(table, parts)],
        "_mix_group string, _mix_cdf array<double>, _mix_parts int"))
    cols = [c for c in docs.columns if c not in (copy_col, key_col)]

    def draw(u: Column) -> Column:
        """Smallest n with P(N <= n) > u."""
        return F.size(F.filter("_mix_cdf", lambda p: p <= u))

    n = draw(F.col("_mix_u"))
    if max(parts, default=1) > 1:       # Poisson draws add up
        n = n + F.aggregate(F.sequence(F.lit(1), F.col("_mix_parts")), F.lit(0), lambda acc, j: acc + F.when(
            j < F.col("_mix_parts"), draw(uniform(seed, "count", F.col(id_col), j))).otherwise(0))
    drawn = (docs.select(*cols, _group(F.col(source_col), weights).alias("_mix_group"),
                         uniform(seed, "count", F.col(id_col)).alias("_mix_u"))
             .join(cdf, "_mix_group").withColumn("_mix_n", n).filter("_mix_n > 0"))
    return (drawn.select(*cols, F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)).alias(copy_col))
            .withColumn(key_col, uniform(seed, "place", F.col(id_col), F.col(copy_col)))
            .repartition(F.col(key_col)).sortWithinPartitions(key_col, id_col))
