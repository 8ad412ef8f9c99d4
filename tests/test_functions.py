"""Semantics of the column helpers."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from quill.functions import (concat0, day_de_month, fixed2, full_name, grouped,
                             has_word_starting, mail_domain, mask_id, money, national_id,
                             round_ratio, title_case, trunc0, years_between)
from quill.functions.case import simple_case
from quill.sources.lenient import lenient_date, lenient_number

D = decimal.Decimal


def col1(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_title_case_splits_on_any_non_alnum(spark):
    out = col1(spark, [("o'higgins ANA-maria pto.montt",), ("muñoz  ñuñoa",), ("2ring x",),
                       (None,)], "s string", title_case("s"))
    assert out == ["O'Higgins Ana-Maria Pto.Montt", "Muñoz  Ñuñoa", "2ring X", None]


def test_word_prefix_like_initcap(spark):
    rows = [("hot ring",), ("ringo",), ("string",), ("x-RING",), ("2ring",)]
    out = col1(spark, rows, "s string", has_word_starting("s", "ring"))
    assert out == [True, True, False, True, False]


def test_concat_null_as_empty(spark):
    out = col1(spark, [("a", None, "c"), (None, None, None)], "a string, b string, c string",
               full_name("a", "b", "c"))
    assert out == ["a  c", "  "]
    out = col1(spark, [("", None)], "a string, b string", concat0("a", "b"))
    assert out == [None]


@pytest.mark.parametrize("value,text,in_mask", [
    ("0", "$0", "$0"), ("-1234.5", "$-1.235", "-$1.235"), ("999.49", "$999", "$999"),
    ("12345678.5", "$12.345.679", "$12.345.679"), (None, None, None)])
def test_money(spark, value, text, in_mask):
    rows = [(D(value) if value is not None else None,)]
    assert col1(spark, rows, "x decimal(18,2)", money("x")) == [text]
    assert col1(spark, rows, "x decimal(18,2)", money("x", symbol_in_mask=True)) == [in_mask]


def test_grouped_and_fixed2(spark):
    rows = [(D("6770.5"),), (D("-0.4"),), (D("0.5"),)]
    assert col1(spark, rows, "x decimal(18,2)", grouped("x")) == ["6.771", "0", "1"]
    assert col1(spark, rows, "x decimal(18,2)", fixed2("x")) == ["6770.50", "-0.40", "0.50"]


def test_round_ratio_exact_half_away(spark):
    rows = [(1, 2), (-1, 2), (1, 3), (2, 3), (5, 0), (61775301, 200)]
    out = col1(spark, rows, "a long, b long", round_ratio("a", "b"))
    assert out == [1, -1, 0, 1, None, 308877]


def test_mean_boundary_not_double_rounded(spark):
    # mean 0.4999975 must round to 0, not via 0.5000 to 1
    rows = [(D("0.4999975"),)]
    df = spark.createDataFrame(rows, "x decimal(18,7)")
    units = df.select((F.col("x") * 10_000_000).cast("long").alias("u"))
    assert units.select(round_ratio("u", F.lit(10_000_000))).first()[0] == 0


def test_trunc_toward_zero(spark):
    assert col1(spark, [(-1.5,), (1.5,)], "x double", trunc0("x")) == [-1, 1]


@pytest.mark.parametrize("n,check,text", [(1234567, "k", "1.234.567-k"),
                                          (12345678, "5", "12.345.678-5"),
                                          (123456789, "0", "123.456.789-0"),
                                          (12, "1", "12-1")])
def test_national_id(spark, n, check, text):
    assert col1(spark, [(n, check)], "n long, c string", national_id("n", "c")) == [text]


def test_mask_id_and_mail(spark):
    rows = [("12345678-9", "ana@mail.cl"), ("nodash", "nomail"), ("123456789012-3", None)]
    df = spark.createDataFrame(rows, "i string, m string")
    out = df.select(mask_id("i"), mail_domain("m")).collect()
    assert [tuple(r) for r in out] == [("**12345678-9", "MAIL.CL"), ("nodash", "NOMAIL"),
                                       ("1234567890-3", None)]


def test_spanish_month(spark):
    rows = [(dt.datetime(2000, 3, 5),), (dt.datetime(2000, 9, 30),)]
    out = col1(spark, rows, "d timestamp_ntz", day_de_month("d"))
    assert out == ["05 de Marzo", "30 de Septiembre"]


def test_years_between_month_end_and_leap(spark):
    rows = [(dt.date(2000, 2, 29),), (dt.date(1995, 8, 16),), (dt.date(1995, 8, 15),)]
    df = spark.createDataFrame(rows, "d date")
    out = [r[0] for r in df.select(years_between(dt.date(2001, 8, 15), "d")).collect()]
    assert out == [1, 5, 6]
    leap = spark.createDataFrame([(dt.date(2000, 2, 29),)], "d date")
    assert leap.select(years_between(dt.date(2001, 2, 28), "d")).first()[0] == 1


def test_lenient_dates_and_numbers(spark):
    rows = [("20121971", "12.5"), ("20/12/1975", " 7 "), ("16-03-2017", "x"), ("1/2/3", None)]
    df = spark.createDataFrame(rows, "d string, n string")
    out = df.select(lenient_date("d"), lenient_number("n")).collect()
    assert [tuple(r) for r in out] == [(dt.date(1971, 12, 20), D("12.50")),
                                       (dt.date(1975, 12, 20), D("7.00")),
                                       (dt.date(2017, 3, 16), None), (None, None)]


def test_simple_case_default_column(spark):
    rows = [("a", 1), ("z", 9)]
    out = col1(spark, rows, "k string, d int", simple_case("k", {"a": 10}, F.col("d")))
    assert out == [10, 9]


def test_null_order_helpers(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    asc = [r.x for r in df.orderBy(F.col("x").asc_nulls_last()).collect()]
    desc = [r.x for r in df.orderBy(F.col("x").desc_nulls_first()).collect()]
    assert asc == [1, 2, None] and desc == [None, 2, 1]
