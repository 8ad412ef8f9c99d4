"""Delimited text into typed rows and a quarantine: every line ends up in one of them."""

import datetime as dt
import decimal
import os
import tempfile

import pytest
from pyspark.sql import types as T

from quill.plans import basics
from quill.sources.delimited import Field, load_delimited, read_delimited

FIELDS = [Field("k", T.LongType(), required=True), Field("name", T.StringType()),
          Field("amount", T.DecimalType(10, 2)), Field("day", T.DateType())]
LINES = ["1;ann;10.5;01/02/2000", "2;bob;;31122001", "x;eve;1;01-02-2000", ";joe;1;01-02-2000", "5;kim;n/a;99/99/2000",
         "6;short", "7;too;1;01-02-2000;many", "8; spaced ; 3 ;01022000", "9;\"semi;colon\";4;", ""]


def _file(lines):
    folder = tempfile.mkdtemp(prefix="quill-text-")
    with open(f"{folder}/in.txt", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def test_good_rows_are_typed_and_bad_ones_named(spark):
    folder = _file(LINES)
    good, bad = load_delimited(spark, f"{folder}/in.txt", FIELDS, f"{folder}/out")
    D, day = decimal.Decimal, dt.date(2000, 2, 1)
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [(1, "ann", D("10.50"), day), (2, "bob", None, dt.date(2001, 12, 31)), (8, " spaced ", D("3.00"), day),
         (9, "semi;colon", D("4.00"), None)], key=str)
    reasons = {r._line: list(r._reasons) for r in bad.collect()}
    assert reasons == {"x;eve;1;01-02-2000": ["k: not bigint"], ";joe;1;01-02-2000": ["k: missing"],
                       "5;kim;n/a;99/99/2000": ["amount: not decimal(10,2)", "day: not date"],
                       "6;short": ["fields"], "7;too;1;01-02-2000;many": ["fields"]}
    assert {r._file for r in bad.collect()} == {"in.txt"}
    # all lines but the blank one, which is no record
    assert good.count() + bad.count() == len(LINES) - 1


def test_target_is_not_overwritten_and_empty_files_load(spark):
    folder = _file([])
    good, bad = load_delimited(spark, f"{folder}/in.txt", FIELDS, f"{folder}/out")
    assert good.count() == bad.count() == 0 and good.columns == ["k", "name", "amount", "day"]
    with pytest.raises(Exception, match="exist"):
        load_delimited(spark, f"{folder}/in.txt", FIELDS, f"{folder}/out")


def test_one_pass_over_the_text(spark, ctx):
    folder = _file(LINES)
    plan = read_delimited(spark, f"{folder}/in.txt", FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan and "Python" not in plan
    rows = basics.csv_load(ctx).groupBy("reasons").count().collect()
    n = ctx.t.orders.count()
    assert sum(r["count"] for r in rows) == n and 0 < sum(r["count"] for r in rows if not r.reasons) < n
    assert os.path.isdir(ctx.store.root)
