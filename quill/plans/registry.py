"""Name → report builder. Each entry takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole input tables, with the fixed run date ``AS_OF``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quill.plans import basics, intervals, listings, sales, stock, summaries, views
from quill.plans.context import Ctx

BUILDERS: dict[str, Callable[[Ctx], DataFrame]] = {
    "avg_ratio_by_type": summaries.avg_ratio_by_type,
    "avg_by_category": summaries.avg_by_category,
    "salary_listing": listings.salary_listing,
    "invoice_listing": listings.invoice_listing,
    "client_credit": listings.client_credit,
    "stock_report": listings.stock_report,
    "stock_report_layout": listings.stock_report_layout,
    "income_bands": listings.income_bands,
    "lookup_plain": listings.lookup_plain,
    "lookup_by_upper": listings.lookup_by_upper,
    "lookup_upper_layout": listings.lookup_upper_layout,
    "cashier_sales": sales.cashier_sales,
    "cashier_sales_safe": sales.cashier_sales_safe,
    "bonus_tenure": sales.bonus_tenure,
    "two_sector_advisers": sales.two_sector_advisers,
    "fee_summary": sales.fee_summary,
    "ctas_fee_summary": sales.ctas_fee_summary,
    "fee_before_after": sales.fee_before_after,
    "update_by_aggregate": sales.update_by_aggregate,
    "update_by_aggregate_ranged": sales.update_by_aggregate_ranged,
    "keep_last": sales.keep_last_ticket,
    "append_bonus_detail": sales.append_bonus_detail,
    "view_raises": views.view_raises,
    "view_readback": views.view_readback,
    "view_fines": views.view_fines,
    "view_fines_salted": views.view_fines_salted,
    "view_fines_brief": views.view_fines_brief,
    "fines_report": views.fines_report,
    "view_clients": views.view_clients,
    "status_at_run_date": views.status_at_run_date,
    "approx_distinct": stock.approx_distinct,
    "stock_control": stock.stock_control,
    "ctas_stock": stock.ctas_stock,
    "payroll": stock.payroll,
    "reload_payroll": stock.reload_payroll,
    "update_literal": stock.update_literal,
    "update_literal_ranged": stock.update_literal_ranged,
    "scan_project": basics.scan_project,
    "lenient_cast_load": basics.lenient_cast_load,
    "csv_load": basics.csv_load,
    "assign_keys": basics.assign_order_keys,
    "band_join_value": basics.band_join_value,
    "band_join_shuffled": basics.band_join_shuffled,
    "band_join_tenure": basics.band_join_tenure,
    "interval_join_status": intervals.interval_join_status,
    "interval_join_prices": intervals.interval_join_prices,
    "interval_audit_deliveries": intervals.interval_audit_deliveries,
    "interval_audit_prices": intervals.interval_audit_prices,
    "semi_exists": basics.semi_exists,
    "intersect_keys": basics.intersect_keys,
    "latest_status": basics.latest_status,
    "audit_pk": basics.audit_pk,
    "audit_fk": basics.audit_fk,
    "audit_fk_keys": basics.audit_fk_keys,
    "audit_dependence": basics.audit_dependence,
    "append_sparse_keys": basics.append_sparse_keys,
    "calendar_pruned": basics.calendar_pruned,
    "audit_on_write": basics.audit_on_write,
    "audit_not_null": basics.audit_not_null,
    "audit_check": basics.audit_check,
    "layout_year_pruned": basics.layout_year_pruned,
    "layout_join_key": basics.layout_join_key,
    "layout_two_columns": basics.layout_two_columns,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Ctx(spark, sf_dir))
    return {name: bind(fn) for name, fn in BUILDERS.items()}


# Reports that write tables (create-as, append, reload, update, layouts):
# building them has side effects, so they are not offered as views.
WRITERS = {"ctas_fee_summary", "fee_before_after", "ctas_stock", "append_bonus_detail", "reload_payroll",
           "update_by_aggregate", "update_literal", "layout_year_pruned", "layout_join_key", "layout_two_columns",
           "lookup_upper_layout", "update_literal_ranged", "update_by_aggregate_ranged",
           "stock_report_layout", "csv_load", "audit_on_write", "append_sparse_keys", "calendar_pruned", "approx_distinct",
           "status_at_run_date"}
# Reports that run a job while being built (checkpoint, axis range).
EAGER = {"assign_keys", "interval_join_status", "interval_join_prices", "interval_audit_deliveries",
         "interval_audit_prices"}


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Expose the input tables and every side-effect-free report as temp
    views, so reports can be queried, joined and filtered with
    ``spark.sql``. Nothing runs until a view is queried; a filter on a
    view is planned together with the report, so it is still pushed down.
    Writers and reports that run a job while being built are left out."""
    ctx = Ctx(spark, sf_dir)
    ctx.t.register()
    names = []
    for name, fn in BUILDERS.items():
        if name in WRITERS or name in EAGER:
            continue
        fn(ctx).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
