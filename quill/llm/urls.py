"""URL filter by association rules.

Fixed rules ``host/path`` come first: a rule fits its host and all subdomains
if the URL's path starts with the rule's path; the longest fitting rule wins.
URLs without a rule are judged by mined rules:

1. a URL is a basket of tokens: scheme, top-level domain, the parts of its
   host, path and query keys (numbers as one token);
2. Spark's FP-growth mines token combinations from the baskets labelled bad; an
   absolute number of them is enough at every table size. Tokens that the same
   bad baskets hold are one item (closed sets), so that a long URL that repeats
   does not breed all sets of its words. One join over all
   labelled baskets counts how often a combination occurs; rules "tokens -> bad"
   are pruned by confidence, a rule that only narrows an at least as confident one goes, and
   so does one that the base rate of bad pages explains (exact binomial bound);
3. every rule is indexed under its rarest token: a URL looks up its tokens
   and checks the few rules found there in full.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep, sized
from quill.llm.quality import binomial_cdf

MIN_SUPPORT_ROWS, MIN_SUPPORT, MIN_CONFIDENCE = 5, 0.0, 0.8
CHANCE = 0.05        # probability that any mined rule holds by chance
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """``(host, path)``; null or no ``://``: both empty."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, null without one.
    ``rules`` are ``(allow or block, "host/path")``."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL."""
    labels = F.split(host, r"[.]")
    words = F.filter(F.split(F.concat_ws("/", F.lower(path)), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    words = F.transform(words, lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x))
    query = F.filter(F.split(F.regexp_extract(F.lower(url), r"\?([^#]*)", 1), r"[&=]"), lambda x: x != "")
    every = F.concat(
        F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"^([^:/]*)://", 1))),
                F.concat(F.lit("tld="), F.element_at(labels, -1))),
        F.transform(F.filter(F.split(F.regexp_replace(host, r"[.][^.]*$", ""), r"[^\p{L}\p{N}]+"),
                             lambda x: x != ""), lambda x: F.concat(F.lit("host="), x)),
        F.transform(words, lambda x: F.concat(F.lit("path="), x)),
        F.transform(query, lambda x: F.concat(F.lit("query="), x)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def _beyond_chance(base: float, level: float):
    """Rules of which so few pages are good with probability ``level`` at most, if
    they were bad at the base rate."""
    def run(batches):
        for b in batches:
            good = [binomial_cdf(f - h, f, 1 - base) <= level
                    for h, f in zip(b.column("hits").to_pylist(), b.column("freq").to_pylist())]
            yield b.filter(pa.array(good, pa.bool_()))
    return run


def mine(baskets: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_SUPPORT_ROWS,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``baskets(items, bad)`` -> ``(rule_id, need, confidence, support)``.

    A rule holds in ``min_rows`` bad baskets at least, however many there are
    (and in a share ``min_support`` of all, if that is given)."""
    schema = "rule_id long, need array<string>, confidence double, support double"
    spark = baskets.sparkSession
    marked = keep(baskets.filter("bad is not null and size(items) > 0")
                  .groupBy(F.array_sort("items").alias("items"))
                  .agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("hits")))
    n, n_bad = marked.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("hits"), F.lit(0))).first()
    if n_bad < min_rows or n_bad == n:          # no rule can beat a base rate of 1
        return spark.createDataFrame([], schema)
    rows, base = max(min_rows, math.ceil(min_support * n)), n_bad / n
    token = keep(marked.select(F.explode("items").alias("token"), "n", "hits").groupBy("token")
                 .agg(F.sum("n").alias("freq"), F.sum("hits").alias("hits")).filter(F.col("hits") >= rows))
    # wider sets need neither a token that is bad wherever it stands (a rule by
    # itself, none is more confident) nor one that every basket holds
    some = keep(token.filter((F.col("hits") < F.col("freq")) & (F.col("freq") < n)).select("token", "freq"))
    bad = keep(marked.filter("hits > 0").select(F.monotonically_increasing_id().alias("id"), "items", "hits")
               .select("id", "hits", F.explode("items").alias("token")).join(some.select("token"), "token"))
    # tokens that the same bad baskets hold are one item to the miner: of their 2^n
    # sets the whole one, which is the most confident, stands for all
    alike = keep(bad.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"),
                                          F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x"), F.sum("hits").alias("hits"))
                 .groupBy("n", "s", "x").agg(F.sort_array(F.collect_list("token")).alias("group"), F.first("hits").alias("hits"))
                 .select(F.element_at("group", 1).alias("token"), "group", "hits"))
    mined = (bad.join(alike.select("token"), "token").groupBy("id", "hits").agg(F.collect_list("token").alias("items")))
    mined = keep(mined.select("items", F.explode(F.sequence(F.lit(1), F.col("hits")))).select("items"))
    one = token.select(F.array("token").alias("need"), "hits", "freq")
    sets, left = one, mined.count()
    if left >= rows:
        # FP-growth rounds minSupport * rows up: half a row less is safe
        model = FPGrowth(itemsCol="items", minSupport=(rows - 0.5) / left).fit(mined)
        found = (model.freqItemsets.select(F.monotonically_increasing_id().alias("id"), "freq", "items")
                 .select("id", "freq", F.explode("items").alias("token"))
                 .join(alike.select("token", "group"), "token").groupBy("id", "freq")
                 .agg(F.sort_array(F.flatten(F.collect_list("group"))).alias("need")))
        wide = keep(found.filter("size(need) > 1")
                    .select(F.monotonically_increasing_id().alias("id"), "need", F.col("freq").alias("hits")))
        # in how many labelled baskets a set occurs: looked up by its rarest token
        index = keep(wide.select("id", "need", F.explode("need").alias("token")).join(some, "token")
                     .groupBy("id", "need").agg(F.min(F.struct("freq", "token")).alias("key"))
                     .select("id", "need", F.col("key.token").alias("token")))
        freq = (marked.select("items", "n", F.explode("items").alias("token")).join(index, "token")
                .filter(F.size(F.array_except("need", "items")) == 0)
                .groupBy("id").agg(F.sum("n").alias("freq")))
        sets = keep(one.unionByName(wide.join(freq, "id").select("need", "hits", "freq")))
    rules = keep(sets.select("need", "hits", "freq", (F.col("hits") / F.col("freq")).alias("confidence"),
                             (F.col("hits") / n).alias("support"))
                 .filter(F.col("confidence") >= min_confidence))
    # a rule narrower than an at least as confident one adds nothing: a rule of n
    # tokens looks for those with one token less (chains reach the shortest)
    less = rules.select(F.explode(F.transform("need", lambda x: F.array_remove("need", x))).alias("inner"),
                        "need", "confidence")
    less = less.join(rules.select(F.col("need").alias("inner"), F.col("confidence").alias("c")), "inner")
    narrow = less.filter("c >= confidence").select("need").distinct()
    # lift: the base rate does not explain the rule, whatever number of sets was tried
    tried = sets.count()
    rules = arrow(rules.join(narrow, "need", "left_anti"), _beyond_chance(base, CHANCE / max(tried, 1)), rules.schema)
    return keep(rules.select(F.monotonically_increasing_id().alias("rule_id"), "need", "confidence", "support"))


def match(pages: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    """``pages(id, items)``, ``rules`` -> ``(id, rule_id, need, confidence)`` of
    the most confident rule that a page meets in full; pages without one are left out."""
    uses = rules.select(F.explode("need").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    # the rarest token among rules is long and specific: a hot token indexes
    # no rule that has a rarer one
    index = keep(rules.select("rule_id", "need", "confidence", F.explode("need").alias("token"))
                 .join(uses, "token").groupBy("rule_id", "need", "confidence")
                 .agg(F.min(F.struct("uses", "token")).alias("key"))
                 .select("rule_id", "need", "confidence", F.col("key.token").alias("token")))
    found = (pages.select(id_col, "items", F.explode("items").alias("token"))
             .join(sized(index, 256), "token")
             .filter(F.size(F.array_except("need", "items")) == 0))
    return found.groupBy(id_col).agg(F.max(F.struct("confidence", "rule_id", "need")).alias("best")).select(
        id_col, "best.*")


def filter_urls(pages: DataFrame, labels: DataFrame, fixed: list[tuple[str, str]],
                id_col: str = "page_id", url_col: str = "url", **mining) -> DataFrame:
    """One row per page: ``(page_id, host, path, rule, verdict, mined)``.

    ``labels`` has ``(page_id, bad)``, bad being true or false. Null URLs and
    URLs without ``://`` have an empty host and path and no token: they are
    allowed, as are URLs that no mined rule meets. ``mined`` is the text of
    the mined rule that blocked a URL. Repeated pages are judged alike; a
    page labelled twice counts as bad if one label says so. Without labels no
    rule is mined. Other columns are ignored, whatever their names.
    """
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    host, path = parts(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    src = (src.withColumn("host", host).withColumn("path", path).withColumn("rule", rule)
           .withColumn("fixed", verdict)
           .withColumn("items", F.coalesce(tokens(F.col("url"), F.col("host"), F.col("path")),
                                           F.array().cast("array<string>"))))
    marks = labels.groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.max("bad").alias("bad"))
    rules = mine(src.join(marks, "page_id").select("items", "bad"), **mining)
    blocked = keep(match(src.filter("fixed is null").select("url", "items").distinct(), rules, "url"))
    blocked = blocked.select("url", F.concat_ws(" ", "need").alias("mined"))
    return (src.join(blocked, "url", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("fixed", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
                    .alias("verdict"),
                    F.when(F.col("rule").isNull(), F.col("mined")).alias("mined")))
