"""The Column helpers and their SQL twins (quill.plans.sqlkit) agree on
random inputs: the differential check relies on both meaning the same."""

import decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quill.functions import (fixed2, grouped, mail_domain, mask_id, money, round_ratio,
                             title_case)
from quill.plans import sqlkit as K

D = decimal.Decimal
money_values = st.decimals(min_value=D("-99999999999.99"), max_value=D("99999999999.99"),
                           places=2, allow_nan=False, allow_infinity=False)
texts = st.text(alphabet=st.sampled_from(list("abcXYZ ñÑéÉ'-.#@1209 _/")), max_size=20)


@pytest.fixture(scope="module")
def con():
    return duckdb.connect()


def duck(con, expr, values, sql_type):
    rel = con.execute(f"SELECT {expr} FROM (SELECT unnest(?::{sql_type}[]) AS x)", [values])
    return [r[0] for r in rel.fetchall()]


def spark_col(spark, expr, values, spark_type):
    df = spark.createDataFrame([(v,) for v in values], f"x {spark_type}")
    return [r[0] for r in df.select(expr.alias("y")).collect()]


@settings(max_examples=5, deadline=None)
@given(vals=st.lists(st.one_of(money_values, st.none()), min_size=1, max_size=25))
def test_money_masks_agree(spark, con, vals):
    for in_mask in (False, True):
        a = spark_col(spark, money(F.col("x"), symbol_in_mask=in_mask), vals, "decimal(18,2)")
        b = duck(con, K.money("x", in_mask=in_mask), [str(v) if v is not None else None
                                                       for v in vals], "DECIMAL(18,2)")
        assert a == b
    assert (spark_col(spark, grouped(F.col("x")), vals, "decimal(18,2)")
            == duck(con, K.grouped("x"), [str(v) if v is not None else None for v in vals],
                    "DECIMAL(18,2)"))
    assert (spark_col(spark, fixed2(F.col("x")), vals, "decimal(18,2)")
            == duck(con, K.fixed2("x"), [str(v) if v is not None else None for v in vals],
                    "DECIMAL(18,2)"))


@settings(max_examples=5, deadline=None)
@given(nums=st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=25),
       den=st.integers(1, 10**6))
def test_round_ratio_agrees(spark, con, nums, den):
    a = spark_col(spark, round_ratio(F.col("x"), F.lit(den)), nums, "long")
    b = duck(con, K.round_ratio("x", str(den)), nums, "BIGINT")
    assert a == b
    exact = [int((D(n) / D(den)).quantize(D(1), rounding=decimal.ROUND_HALF_UP)) for n in nums]
    assert a == exact


@settings(max_examples=5, deadline=None)
@given(vals=st.lists(st.one_of(texts, st.none()), min_size=1, max_size=25))
def test_text_helpers_agree(spark, con, vals):
    for col_fn, sql_fn in ((title_case, K.title_case), (mask_id, K.mask_id),
                           (mail_domain, K.mail_domain)):
        a = spark_col(spark, col_fn(F.col("x")), vals, "string")
        b = duck(con, sql_fn("x"), vals, "VARCHAR")
        assert a == b, col_fn.__name__


def test_cents_of_doubles_match_duckdb_cast(spark, con):
    from quill.functions import cents
    vals = [0.145, 0.125, 0.135, 2.675, -0.145, 1.005, 1863.84, -994.28, 0.0]
    a = spark_col(spark, cents(F.col("x")), vals, "double")
    b = duck(con, K.cents("x"), vals, "DOUBLE")
    assert a == b
    exact = spark_col(spark, cents(F.col("x")), [D("0.145"), D("-2.675")], "decimal(10,3)")
    assert exact == [15, -268]   # decimal input: exact half away from zero
