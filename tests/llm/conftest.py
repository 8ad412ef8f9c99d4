import random

import pytest
from llm_helpers import sentence
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, and columns whose
    names clash with those that operators use inside."""
    r = random.Random(5)
    long = "\n".join(sentence(r, 12) for _ in range(3000))
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, None, None, None, None),
            (3, "", "en", "s", 0), (4, " \n\t ", "de", "t", 4), (None, "a b c d e f g", "en", "s", 1),
            (None, None, None, None, None), (5, long, "en", "s", 9), (6, long + " tail", "en", "s", 9),
            (7, "éè ü 中文 \U0001f600 x", "fr", "u", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("id", "key", "keys", "n", "node", "comp", "rep", "label", "copy", "kept", "size", "a", "b", "fp",
              "stratum", "rank", "length", "drop", "rest", "line", "unit", "score", "toxic", "fold"):
        df = df.withColumn(c, F.lit("clash"))
    return df
