"""Grouped summaries with banded classes (R8 mean salary by category and
branch; R9 mean price, size and price-per-size by type)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.functions import cents, mean_rounded, money, round_ratio
from quill.functions.case import simple_case
from quill.plans.context import Ctx
from quill.sources.params import exact

PART_TYPE_LABELS = {"ECONOMY": "economy line", "STANDARD": "standard line",
                    "SMALL": "small format", "MEDIUM": "medium format",
                    "LARGE": "large format"}
SEGMENT_LABELS = {"AUTOMOBILE": "automotive", "BUILDING": "construction",
                  "FURNITURE": "furnishing", "MACHINERY": "industrial"}
REGION_LABELS = {0: "branch africa", 1: "branch america", 2: "branch asia",
                 3: "branch europe"}


def avg_ratio_by_type(ctx: Ctx, having_min: float = 80, low: int = 85, high: int = 95
                      ) -> DataFrame:
    """Per type — count, mean price, mean size, mean of the per-row
    price/size ratio (mean of ratios, not ratio of means), and a class on
    the rounded ratio; types with a mean ratio <= ``having_min`` are dropped."""
    p = ctx.t.part
    g = (p.groupBy("p_type")
         .agg(F.count(F.lit(1)).alias("total_items"),
              F.sum(cents("p_retailprice")).alias("_price_cents"),
              F.sum("p_size").alias("_size_sum"),
              F.avg(F.col("p_retailprice") / F.col("p_size")).alias("_ratio"))
         .filter(F.col("_ratio") > F.lit(having_min)))
    ratio = F.round(F.col("_ratio"), 0).cast("long")
    return (g.select(
        F.col("p_type").alias("type_code"),
        simple_case(F.col("p_type"), PART_TYPE_LABELS, "other").alias("type_label"),
        F.col("total_items"),
        money(mean_rounded(F.col("_price_cents"), F.col("total_items")), symbol_in_mask=True)
        .alias("mean_price"),
        round_ratio(F.col("_size_sum"), F.col("total_items")).alias("mean_size"),
        ratio.alias("price_per_size"),
        F.when(ratio < low, "economy").when(ratio.between(low, high), "medium")
        .when(ratio > high, "high").otherwise("n/a").alias("price_class"))
        .orderBy(F.col("price_per_size").desc_nulls_first(), "type_code"))


def avg_by_category(ctx: Ctx, min_mean="4400") -> DataFrame:
    """Mean balance by segment x region (codes mapped to labels by simple
    CASE, unmapped codes to a default); groups with mean <= ``min_mean`` are
    dropped; sorted by the mean, which is not shown raw."""
    c = ctx.t.customer
    n = ctx.t.nation.select("n_nationkey", "n_regionkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    g = (j.groupBy("c_mktsegment", "n_regionkey")
         .agg(F.sum(cents("c_acctbal")).alias("_s"), F.count("c_acctbal").alias("_n"))
         # cents against the exact parameter, cross-multiplied: no rounding
         .filter(F.col("_s").cast("decimal(38,6)") > F.lit(exact(min_mean) * 100) * F.col("_n")))
    mean = mean_rounded(F.col("_s"), F.col("_n"))
    return (g.select(
        simple_case(F.col("c_mktsegment"), SEGMENT_LABELS, "undefined").alias("category"),
        simple_case(F.col("n_regionkey"), REGION_LABELS, "undefined").alias("branch"),
        money(mean, symbol_in_mask=True).alias("mean_balance"),
        F.col("_s"), F.col("_n"))
        .orderBy((F.col("_s") / F.col("_n")).desc_nulls_first(), "category", "branch")
        .drop("_s", "_n"))
