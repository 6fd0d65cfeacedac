"""Rule-based pricing review score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.config import (REVIEW_TOP_N, SCORE_WEIGHTS, STALENESS_DEFAULT, STALENESS_STEPS,
                             URGENCY_BUCKETS, URGENCY_DEFAULT, Params)
from feedlens.functions.columns import (as_of_lit, days_until, epoch_seconds, hour_boundaries_between,
                                        round_half_away)
from feedlens.operators.common import asc, desc, for_run, join_small_side, market_events, top_then_expand
from feedlens.operators.reports import grouped_price_stats


# R01
def category_median(t, p: Params) -> DataFrame:
    """Median positive price per category (a bounded table: one row per category)."""
    me = market_events(t, p).where(F.col("get_in_price") > 0)
    st = grouped_price_stats(me, ["category_type"], median=p.median, small_groups=0)
    return st.select("category_type", F.col("_median").alias("cat_median_price"))


def three_day(t, p: Params) -> DataFrame:
    return (for_run(t.windows, p)
            .where((F.col("window_days") == F.lit(3)) & (F.col("insufficient_data") == F.lit(False)))
            .select("event_id", F.abs("raw_change").alias("abs_3d_change")))


# R02
def movement_scale(t, p: Params) -> DataFrame:
    return three_day(t, p).agg(F.max("abs_3d_change").alias("max_abs_3d_change"))


# R03
def quantity_scale(t, p: Params) -> DataFrame:
    return (for_run(t.market, p).where(F.col("stats_total_quantity") > 0)
            .agg(F.max("stats_total_quantity").alias("max_quantity")))


def _urgency(days):
    expr = None
    for lo, hi, score in URGENCY_BUCKETS:
        cond = days.between(lo, hi)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(URGENCY_DEFAULT))


def _staleness(hours):
    expr = None
    for threshold, score in STALENESS_STEPS:
        cond = hours > F.lit(threshold)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(STALENESS_DEFAULT))


def scored_events(t, p: Params) -> DataFrame:
    """One row per priced event with its six component scores.

    The two scales are one row each (a bound known from the plan) and are
    broadcast. Category medians are one row per category; they are written,
    and broadcast once that size is measured (join_small_side), because a shuffle
    join on a handful of categories would put each category in one task."""
    as_of = as_of_lit(p)
    me = market_events(t, p).where(F.col("get_in_price") > 0)
    cm = category_median(t, p)
    scales = F.broadcast(movement_scale(t, p).crossJoin(quantity_scale(t, p)))
    days = days_until(as_of, F.col("event_utc_datetime"))
    real = ((F.col("forecast_is_available") == F.lit(True))
            & ~F.col("forecast_value").isin(*[float(s) for s in p.sentinels]))
    qty_ratio = F.col("stats_total_quantity").cast("double") / F.col("max_quantity")
    return (
        join_small_side(me, cm, "category_type", "left")
        .join(three_day(t, p), "event_id", "left")
        .crossJoin(scales)
        .select(
            "event_id", "title", "category_type", "event_category_name", "get_in_price",
            "stats_total_quantity", "forecast_is_available", "forecast_value", "stats_last_updated_at",
            "event_utc_datetime",
            days.alias("days_until_event"),
            F.least(F.lit(1.0), F.coalesce(F.col("get_in_price") / F.nullif(F.col("cat_median_price"), F.lit(0.0)),
                                           F.lit(0.0)) / F.lit(2.0)).alias("price_score"),
            F.when(F.col("max_quantity") > 0, F.lit(1.0) - F.least(F.lit(1.0), qty_ratio))
             .otherwise(F.lit(0.0)).alias("supply_score"),
            F.when(F.col("max_abs_3d_change") > 0,
                   F.least(F.lit(1.0), F.coalesce(F.col("abs_3d_change"), F.lit(0.0)) / F.col("max_abs_3d_change")))
             .otherwise(F.lit(0.0)).alias("movement_score"),
            F.when(real, F.col("forecast_value")).otherwise(F.lit(0.0)).alias("forecast_score"),
            _urgency(days).alias("urgency_score"),
            _staleness(hour_boundaries_between("stats_last_updated_at", as_of)).alias("staleness_score"),
        )
    )


COMPONENTS = ("price", "supply", "movement", "forecast", "urgency", "staleness")


def review_score_expr():
    total = None
    for name in COMPONENTS:
        term = F.lit(SCORE_WEIGHTS[name]) * F.col(f"{name}_score")
        total = term if total is None else total + term
    return round_half_away(total, 3)


# R04
def component_scores(t, p: Params) -> DataFrame:
    s = scored_events(t, p).join(t.event_venues, "event_id").join(t.venues, "venue_slug")
    return s.select("event_id", "venue_name", "city", "state", "days_until_event",
                    *[f"{c}_score" for c in COMPONENTS])


# R05
def pricing_review(t, p: Params, n: int = REVIEW_TOP_N) -> DataFrame:
    s = scored_events(t, p).withColumn("review_score", review_score_expr())
    order = desc("review_score") + asc("event_id")
    rows = top_then_expand(s, order, n, t.event_venues).join(t.venues, "venue_slug")
    return (rows.select(
                "event_id", "title", "category_type", "event_category_name", "venue_name", "city", "state",
                "get_in_price", "stats_total_quantity", "forecast_is_available",
                round_half_away("forecast_value", 3).alias("forecast_value"),
                "days_until_event",
                epoch_seconds("stats_last_updated_at").alias("last_updated_epoch"),
                "review_score",
                *[round_half_away(f"{c}_score", 3).alias(f"{c}_score") for c in COMPONENTS],
                "event_utc_datetime")
            .orderBy(*order, *asc("venue_name", "city", "state")).limit(n))
