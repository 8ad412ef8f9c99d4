"""The command line: list and run a report with parameters."""

import tempfile

import pytest

from quill.__main__ import main

from conftest import SF_SMALL


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "income_bands" in out and "cashier_sales" in out


def test_run_with_params_and_output(spark):
    out = tempfile.mkdtemp(prefix="quill-cli-") + "/income"
    assert main(["run", "income_bands", "--data", SF_SMALL, "--param", "min_income=2000",
                 "--param", "max_income=2500", "--out", out, "--show", "0"]) == 0
    rows = spark.read.parquet(out).collect()
    assert rows and all(r.income_band == "band 3" for r in rows)


def test_register_views_for_sql(spark):
    from quill.plans.registry import register_views
    names = register_views(spark, SF_SMALL)
    assert "salary_listing" in names and "ctas_stock" not in names
    n = spark.sql("SELECT count(*) FROM salary_listing WHERE city = 'NATION_9'").first()[0]
    direct = spark.sql("SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey "
                       "WHERE n_name = 'NATION_9' AND c_acctbal BETWEEN 650 AND 3000").first()[0]
    assert n == direct


def test_parameterised_sql_over_views(spark):
    from quill.plans.registry import register_views
    register_views(spark, SF_SMALL)
    df = spark.sql("SELECT * FROM income_bands WHERE income_band = :band", args={"band": "band 1"})
    assert df.count() > 0 and {r.income_band for r in df.collect()} == {"band 1"}


def test_run_all_writes_every_plain_report(spark):
    from quill.plans.registry import BUILDERS, EAGER, WRITERS
    out = tempfile.mkdtemp(prefix="quill-all-") + "/reports"
    assert main(["run-all", "--data", SF_SMALL, "--out", out]) == 0
    expected = set(BUILDERS) - WRITERS - EAGER
    for name in expected:
        assert spark.read.parquet(f"{out}/{name}").schema.fieldNames()


@pytest.mark.parametrize("report,param,fine", [("invoice_listing", "vat=0.19", "vat=0.20"),
                                               ("stock_report", "offer_factor=0.9", "offer_factor=0.85"),
                                               ("stock_report", "rate=950.1", "rate=950"),
                                               ("avg_by_category", "min_mean=4400.005", "min_mean=9000")])
def test_decimal_parameters(spark, report, param, fine):
    got = []
    for p in (param, fine):
        out = tempfile.mkdtemp(prefix="quill-cli-") + "/out"
        # the small table's only part in the report has too few units for the default offer
        more = ["--param", "offer_min=0"] if report == "stock_report" else []
        assert main(["run", report, "--data", SF_SMALL, "--param", p, *more, "--out", out, "--show", "0"]) == 0
        got.append(sorted(map(str, spark.read.parquet(out).collect())))
    assert got[0] != got[1]


def test_decimal_parameters_are_exact():
    from decimal import Decimal

    from quill.__main__ import _value
    from quill.sources.params import exact
    assert _value("0.19") == Decimal("0.19") and _value("7") == 7 and _value("BUILDING") == "BUILDING"
    assert exact(0.1) == exact("0.1") == exact(Decimal("0.1"))
