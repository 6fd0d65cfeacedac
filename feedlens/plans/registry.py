"""Named queries over the driver tables: key -> callable(spark, sf_dir)."""

from __future__ import annotations

from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlens.config import Params
from feedlens.operators import kpis, quality, reports, scoring
from feedlens.session import pin_utc
from feedlens.sources.driver import driver_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_driver(op, spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    p = Params()
    return op(driver_tables(spark, sf_dir, p), p)


def _dq_then(op, t, p):
    return op(quality.run_checks(t, p))


def _dq_report(t, p):
    return quality.dq_report(quality.dq_suite(t, p))


def _one_check(key, t, p):
    return quality.run_checks(t, p, [key])


TABLE_OPS = {
    # O01-O15
    "events_by_category": reports.events_by_category,
    "events_by_geography": reports.events_by_geography,
    "top20_by_price": reports.top_by_price,
    "top20_by_quantity": reports.top_by_quantity,
    "top20_move_3d": partial(reports.top_movement, days=3),
    "top20_move_7d": partial(reports.top_movement, days=7),
    "zero_price_events": reports.zero_price_events,
    "stale_stats": reports.stale_stats,
    "forecast_available": reports.forecast_available,
    "forecast_coverage": reports.forecast_coverage,
    "median_price_by_category": reports.median_price_by_category,
    "median_price_by_venue": reports.median_price_by_venue,
    "suspicious_changes": reports.suspicious_changes,
    "counts_by_source_file": reports.counts_by_source_file,
    "dq_report": _dq_report,
    # R01-R05
    "category_median": scoring.category_median,
    "movement_scale": scoring.movement_scale,
    "quantity_scale": scoring.quantity_scale,
    "component_scores": scoring.component_scores,
    "pricing_review": scoring.pricing_review,
    # K01-K06
    "kpi_totals": kpis.kpi_totals,
    "kpi_zero_stale": kpis.kpi_zero_stale,
    "kpi_forecast_pct": kpis.kpi_forecast_pct,
    "kpi_suspicious_events": kpis.kpi_suspicious_events,
    "kpi_leaders": kpis.kpi_leaders,
    "kpi_dq_fails": partial(_dq_then, kpis.kpi_dq_fails),
    # D00-D24
    "dq_suite": quality.dq_suite,
    "dq_failing_rows": quality.failing_rows,
    "dq_summary": partial(_dq_then, quality.dq_summary),
}
TABLE_OPS.update({k: partial(_one_check, k) for k in quality.SUITE_ORDER})


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {k: partial(_on_driver, op) for k, op in TABLE_OPS.items()}
    from feedlens.plans import feed_queries
    out.update(feed_queries.queries())
    return out


def oracle_sql() -> dict[str, str]:
    from feedlens.plans.oracles import all_sql
    out = all_sql()
    from feedlens.plans import feed_queries
    out.update(feed_queries.oracle_sql())
    return out
