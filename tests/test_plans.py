"""Plan shape of every report: no Cartesian product or nested-loop join, no
Python evaluation node, and calendar filters pushed into the Parquet scan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quill.operators.keys import block_keys
from quill.operators.mutate import update_where
from quill.plans import basics, sales, stock
from quill.plans.context import Ctx
from quill.plans.registry import BUILDERS, WRITERS

from conftest import SF_SMALL

BAD = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
       "FlatMapGroupsInPandas", "MapInPandas"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """As at scale: no join side is small enough to be broadcast by itself."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# what every writing query writes
WRITTEN = {
    "ctas_fee_summary": sales.fee_summary,
    "fee_before_after": lambda c: sales.raise_salaries(c, sales.staff_table(c)),
    "ctas_stock": stock.stock_control,
    "append_bonus_detail": sales.bonus_detail,
    "reload_payroll": stock.payroll,
    "update_by_aggregate": lambda c: sales.raise_salaries(c, sales.staff_table(c)),
    "update_literal": lambda c: update_where(c.t.part.withColumn("related_part", F.lit(None).cast("long")),
                                             {"related_part": F.lit(1)}, F.col("p_partkey") <= 99),
    "update_literal_ranged": stock.product_table,
    "update_by_aggregate_ranged": lambda c: sales.raise_salaries(c, sales.staff_table(c)),
    "layout_year_pruned": lambda c: c.t.orders,
    "layout_join_key": lambda c: c.t.orders,
    "layout_two_columns": lambda c: c.t.lineitem,
    "lookup_upper_layout": lambda c: c.t.part,
    "stock_report_layout": lambda c: c.t.part,
    "csv_load": basics.order_lines,
    "audit_on_write": lambda c: c.t.customer,
    "append_sparse_keys": lambda c: block_keys(c.t.orders),
    "calendar_pruned": basics.calendar_table,
    "approx_distinct": lambda c: c.t.lineitem,
    "status_at_run_date": lambda c: c.t.orders,
}


def test_every_writer_is_covered():
    assert set(WRITTEN) == WRITERS


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_no_slow_operators(spark, name, no_broadcast):
    text = plan_text(BUILDERS[name](Ctx(spark, SF_SMALL)))
    if name in WRITTEN:
        text += plan_text(WRITTEN[name](Ctx(spark, SF_SMALL)))
    for op in BAD:
        assert op not in text, f"{name}: {op}"


# a struct buffer (rows of any type) sorts; everything else hashes
SORTS = {"latest_status", "status_at_run_date"}


@pytest.mark.parametrize("name", sorted(set(BUILDERS) - SORTS))
def test_aggregates_do_not_sort(spark, name, no_broadcast):
    text = plan_text(BUILDERS[name](Ctx(spark, SF_SMALL)))
    if name in WRITTEN:
        text += plan_text(WRITTEN[name](Ctx(spark, SF_SMALL)))
    assert "SortAggregate" not in text


def test_two_sector_and_latest_status_filters_reach_the_scan(spark):
    ctx = Ctx(spark, SF_SMALL)
    assert "In(o_orderstatus, [F,O])" in plan_text(sales.two_sector_advisers(ctx))
    text = plan_text(basics.latest_status(ctx))
    assert "EqualTo(o_orderstatus,O)" in text and "GreaterThanOrEqual(o_orderdate,1999-08-17" in text


def test_cashier_sales_filters_before_it_aggregates(spark, no_broadcast):
    text = plan_text(sales.cashier_sales(Ctx(spark, SF_SMALL)))
    assert text.count("LeftSemi") >= 2


def test_bucketed_side_is_not_shuffled(spark, no_broadcast):
    text = plan_text(basics.layout_join_key(Ctx(spark, SF_SMALL)))
    side = text[text.index("quill_orders_by_customer") - 600:]
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning(c_custkey") == 1
    assert "Exchange hashpartitioning(o_custkey" not in side


def test_two_column_layout_pushes_both_bounds(spark):
    text = plan_text(basics.layout_two_columns(Ctx(spark, SF_SMALL)))
    assert "EqualTo(l_partkey,77)" in text and "GreaterThanOrEqual(l_shipdat" in text


@pytest.mark.parametrize("name,pushed", [
    ("invoice_listing", "GreaterThanOrEqual(o_orderdate,2000-01-01"),
    ("fee_summary", "GreaterThanOrEqual(o_orderdate,2000-04-01"),
    ("view_fines", "GreaterThan(l_shipdate,1999-01-01"),
    ("salary_listing", "GreaterThanOrEqual(c_acctbal,650.0)"),
    ("lookup_plain", "EqualTo(p_name,hot ring)"),
])
def test_filters_pushed_to_scan(spark, name, pushed):
    text = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert pushed in text


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["two_sector_advisers"](spark, SF_SMALL)
    text = plan_text(df)
    assert "o_orderpriority" not in text and "o_orderdate" not in text


def test_layout_prunes_partitions(spark):
    df = E.queries()["layout_year_pruned"](spark, SF_SMALL)
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(o_year" in text and "(o_year#" in text


def test_upper_key_layout_pushes_equality(spark):
    df = E.queries()["lookup_upper_layout"](spark, SF_SMALL)
    assert "EqualTo(name_key,HOT RING)" in plan_text(df)


def test_row_number_form_gets_partial_group_limit(spark, ctx):
    from quill.plans.basics import latest_status
    text = plan_text(latest_status(ctx, method="window"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_word_prefix_is_pushed_into_the_inverted_table(spark, no_broadcast):
    from quill.plans import listings
    ctx = Ctx(spark, SF_SMALL)
    text = plan_text(listings.stock_report_layout(ctx))
    assert "StringStartsWith(word,ring)" in text and "LeftSemi" in text


def test_prefix_search_skips_row_groups(spark):
    """Words are sorted over the files: the footers' ranges leave few groups for a prefix."""
    import glob

    import pyarrow.parquet as pq

    from quill.sources.layout import inverted_by_word, with_word_starting
    ctx = Ctx(spark, SF_SMALL)
    df = spark.range(4000).select("id", F.format_string("Word%03d-tail x%d", F.col("id") % 500, F.col("id")).alias("t"))
    words = inverted_by_word(ctx.store, df, "words_test", "id", "t", partitions=8)
    got = with_word_starting(df, words, "id", "Word12")
    assert sorted(r.id for r in got.collect()) == [i for i in range(4000) if f"{i % 500:03d}".startswith("12")]
    groups = hit = 0
    for f in glob.glob(f"{ctx.store.current_paths('words_test')[0]}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            st = meta.row_group(g).column(0).statistics
            groups += 1
            hit += st.min <= "word12￿" and st.max >= "word12"
    assert groups >= 6 and hit <= 2


def test_calendar_prunes_folders_at_run_time(spark):
    ctx = Ctx(spark, SF_SMALL)
    df = basics.calendar_pruned(ctx)
    years = {r.o_year for r in df.select("o_year").distinct().collect()}
    assert years == {ctx.as_of.year - 1, ctx.as_of.year - 2}
    assert "dynamicpruning" in plan_text(df)
    df.collect()
    plan, read = df._jdf.queryExecution().executedPlan(), []
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    todo = [plan]
    while todo:
        p = todo.pop()
        if "Scan parquet" in p.nodeName() and p.metrics().contains("numPartitions"):
            read.append(p.metrics().apply("numPartitions").value())
        for attr in ("plan", "child"):
            if "QueryStage" in p.nodeName() and attr == "plan":
                todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    assert 2 in read, read


def test_block_keys_are_one_pass(spark):
    text = plan_text(block_keys(spark.read.parquet(f"{SF_SMALL}/orders.parquet")))
    assert "Exchange" not in text and "Sort" not in text
