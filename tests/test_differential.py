"""Every registered query against its DuckDB twin on sf0.001 (the driver's
check runs the same comparison on sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from quill.plans.registry import BUILDERS
from tools.compare import TABLES, rows_key

from conftest import SF_SMALL

NAMES = sorted(BUILDERS)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(BUILDERS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_key(df.columns, df.collect()) == rows_key(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["invoice_listing", "fee_summary", "view_fines", "bonus_tenure",
                                  "lenient_cast_load", "semi_exists", "layout_year_pruned"])
def test_date_queries_independent_of_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(E.oracle_sql()[name])
    assert rows_key(df.columns, rows) == rows_key([d[0] for d in res.description], res.fetchall())


@pytest.mark.parametrize("name", ["cashier_sales", "bonus_tenure", "view_fines", "stock_control",
                                  "payroll", "append_bonus_detail", "two_sector_advisers",
                                  "audit_fk", "intersect_keys"])
def test_cluster_shaped_plans(spark, con, name):
    """As at scale: no automatic broadcast, no AQE re-planning — every data
    join is a sort-merge join — and the results are unchanged."""
    keys = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = df.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    res = con.execute(E.oracle_sql()[name])
    assert rows_key(df.columns, rows) == rows_key([d[0] for d in res.description], res.fetchall())
