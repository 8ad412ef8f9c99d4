"""Salting for joins whose big side may hold a hot key.

AQE's skew-join handling splits an oversized shuffle partition at run time and
is the default everywhere. For sessions without AQE, this operator spreads
every key instead: rows of the big side get a salt ``0..salts-1`` from a hash
of columns that tell its rows apart, rows of the small side are replicated once
per salt, and the join runs on (keys, salt). Each big row still meets exactly
its partners, and any key, however hot, is spread over ``salts`` tasks. Nothing
is counted, collected or capped; the price is the small side ``salts`` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salt_on: list[str],
                how: str = "inner", salts: int = 32) -> DataFrame:
    """``big JOIN small USING (keys)``, every key spread over ``salts`` tasks.

    ``how`` is ``inner`` or ``left`` (every ``big`` row kept). ``salt_on`` names
    columns of ``big`` whose values differ between rows of one key (its own row
    key); only these and the columns used downstream are read. Column names of
    the two sides must not overlap except for ``keys``."""
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(spread, [*keys, "_salt"], how).drop("_salt")
