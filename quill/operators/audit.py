"""Rule audits: the reference declares keys, references, NOT NULL and CHECK
rules that its database enforces on write. Spark enforces none of them, so
each becomes a job that *finds* violations. Violations have one shape::

    table_name, rule, column_name, key_value (string), n (long)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["table_name", "rule", "column_name", "key_value", "n"]


def _key_text(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Primary-key rule: key values occurring more than once (or with a NULL part).

    Nearly all keys differ, so a task holds as many groups as it reads rows, and
    AQE gives it rows by their compressed bytes. Keys in sequence shrink to
    almost none, all of them into one task; the hash beside them does not, which
    holds a task to the advisory size / 8 bytes of groups."""
    g = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = g.filter((F.col("n") > 1) | has_null)
    return bad.select(F.lit(table).alias("table_name"),
                      F.when(has_null, F.lit("pk_null")).otherwise(F.lit("pk_duplicate"))
                      .alias("rule"),
                      F.lit(",".join(keys)).alias("column_name"),
                      _key_text(keys).alias("key_value"), F.col("n").cast("long").alias("n"))


def orphans(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key rule, one row per reference: how many child rows were checked
    (NULLs are allowed and not checked) and how many have no parent row.

    The child is aggregated on the reference first, so a hot value becomes one
    row before the join; a parent key that occurs twice collapses again in an
    aggregation that needs no further shuffle."""
    refs = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    met = refs.join(parent.select(F.col(pk).alias(fk), F.lit(1).alias("hit")), fk, "left")
    one = met.groupBy(fk).agg(F.max("n").alias("n"), F.max("hit").alias("hit"))
    total = one.agg(F.sum("n").alias("checked"), F.sum(F.when(F.col("hit").isNull(), F.col("n"))).alias("orphans"))
    return total.select(F.lit(table).alias("table_name"), F.lit("fk_orphan").alias("rule"),
                        F.lit(fk).alias("column_name"),
                        F.coalesce("checked", F.lit(0)).cast("long").alias("checked"),
                        F.coalesce("orphans", F.lit(0)).cast("long").alias("n"))


def null_counts(df: DataFrame, table: str, cols: list[str], keep_zero: bool = False
                ) -> DataFrame:
    """NOT NULL rule: NULL count per column, all columns in one scan
    (``keep_zero`` also lists the clean columns, as a profile)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in cols]))
    return (agg.select(rows.alias("r"))
            .select(F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"),
                    F.col("r.c").alias("column_name"), F.lit(None).cast("string").alias("key_value"),
                    F.col("r.n").cast("long").alias("n"))
            .filter(F.lit(keep_zero) | (F.col("n") > 0)))


def check_rules(df: DataFrame, table: str, keys: list[str],
                rules: list[tuple[str, str, Column]]) -> DataFrame:
    """CHECK / domain / length rules: ``(rule, column, ok_predicate)``.

    A row violates a rule when the predicate is FALSE (NULL passes, as in SQL
    CHECK constraints). One scan evaluates all rules; each violation is a row.
    """
    flags = F.array(*[F.when(~F.coalesce(ok, F.lit(True)),
                             F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name")))
                      for r, c, ok in rules])
    return (df.select(_key_text(keys).alias("key_value"), F.explode(flags).alias("v"))
            .filter(F.col("v").isNotNull())
            .select(F.lit(table).alias("table_name"), F.col("v.rule").alias("rule"),
                    F.col("v.column_name").alias("column_name"), "key_value",
                    F.lit(1).cast("long").alias("n")))


def orphan_keys(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key rule, the offenders: each reference without a parent row and
    how many child rows carry it. The child is aggregated first, so the anti
    join sees a hot value once."""
    refs = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    lost = refs.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return lost.select(F.lit(table).alias("table_name"), F.lit("fk_orphan").alias("rule"),
                       F.lit(fk).alias("column_name"), F.col(fk).cast("string").alias("key_value"),
                       F.col("n").cast("long").alias("n"))


def dependences(df: DataFrame, table: str, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Functional dependences: for each of ``keys``, which other columns do not follow
    from it, ``(table_name, key_column, column_name, groups, n)`` with the number
    of key values and of those that carry more than one value (NULL is one).

    A column depends on the key where the least and the greatest hash of its
    values agree in every group: one aggregation, one shuffle per key, of two
    numbers a column. NULL keys are a group."""
    out = []
    for key in keys:
        own = [c for c in columns or df.columns if c != key]
        hashes = {c: F.xxhash64(F.col(c).isNull(), c) for c in own}
        g = df.groupBy(key).agg(*[f(h).alias(f"{part}_{c}") for c, h in hashes.items()
                                  for f, part in ((F.min, "lo"), (F.max, "hi"))])
        one = g.agg(F.count(F.lit(1)).alias("groups"),
                    *[F.count_if(F.col(f"lo_{c}") != F.col(f"hi_{c}")).alias(c) for c in own])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in own]))
        out.append(one.select("groups", rows.alias("r")).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), F.col("r.c").alias("column_name"),
            F.col("groups").cast("long").alias("groups"), F.col("r.n").cast("long").alias("n")))
    return union_all(out)


def write_rules(schema, not_null: list[str] = (), rules: list[tuple[str, str, Column]] = ()) -> dict[str, Column]:
    """Rules for an audited write (``TableStore``): NOT NULL columns and CHECK rules
    as ``{rule: what must not be FALSE}``."""
    out = {f"not_null:{c}": F.col(c).isNotNull() for c in not_null if c in schema.fieldNames()}
    return out | {f"{r}:{c}": ok for r, c, ok in rules}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
