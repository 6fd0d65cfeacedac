"""Analytical result sets (O01-O15). Each takes the FeedTables bundle and
Params and returns a lazy DataFrame; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.config import (TOP_MOVEMENT_N, TOP_PRICE_N, TOP_QUANTITY_N, TOP_VENUE_N,
                             VENUE_MIN_EVENTS, Params)
from feedlens.functions.columns import as_of_lit, hours_between, is_real_forecast, round_half_away
from feedlens.operators.common import asc, desc, for_run, market_events, top_then_expand, written
from feedlens.operators.stats import SMALL_GROUP_DISTINCT, median_from_counts


def cents(col):
    return F.round(F.col(col) * F.lit(100.0), 0).cast("bigint")


def exact_median(col: str, freq: str | None = None):
    """Exact median as one aggregate (linear interpolation of the middles)."""
    return F.percentile(F.col(col), F.lit(0.5), F.col(freq) if freq else F.lit(1))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def grouped_price_stats(df: DataFrame, keys: list[str], price: str = "get_in_price",
                        median: str = "distributed", small_groups: int = SMALL_GROUP_DISTINCT) -> DataFrame:
    """count, median, average, min, max of ``price`` per ``keys``.

    Rows are first collapsed to (keys, price) -> frequency: a shuffle that
    spreads a hot group over every reducer. The median is then taken by
    distributed rank selection (default), so no task holds a whole group; its
    rounds all read the frequencies, which are therefore written once. With
    ``small_groups`` 0 (few, large groups such as categories) every group takes
    the rank selection.
    The average is taken over integer cents so it does not depend on
    summation order."""
    per_value = (df.where(F.col(price).isNotNull()).groupBy(*keys, price)
                 .agg(F.count(F.lit(1)).alias("_n"), F.sum(cents(price)).alias("_cents")))
    base = [F.sum("_n").alias("_count"), F.sum("_cents").alias("_cents"),
            F.min(price).alias("_min"), F.max(price).alias("_max")]
    if median == "distributed":
        per_value = written(per_value, "price-counts")
        st = per_value.groupBy(*keys).agg(*base)
        med = median_from_counts(per_value, keys, price, "_n",
                                 small_group_distinct=small_groups).withColumnRenamed("median", "_median")
        return null_safe_join(st, med, keys, "left")
    med = (F.percentile_approx(price, 0.5, 10000).cast("double") if median == "approx"
           else exact_median(price, "_n"))
    return per_value.groupBy(*keys).agg(*base, med.alias("_median"))


def avg_from_cents(sum_cents="_cents", n="_count"):
    return F.round(F.col(sum_cents).cast("double") / F.col(n).cast("double"), 0) / F.lit(100.0)


# O01
def events_by_category(t, p: Params) -> DataFrame:
    return (t.events.groupBy("category_type", "event_category_name")
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(*desc("event_count"), *asc("category_type", "event_category_name")))


# O02
def events_by_geography(t, p: Params) -> DataFrame:
    return (t.event_venues.join(t.venues, "venue_slug")
            .groupBy("country", "state", "city")
            .agg(F.countDistinct("event_id").alias("event_count"))
            .orderBy(*desc("event_count"), *asc("country", "state", "city")))


# O03
def top_by_price(t, p: Params, n: int = TOP_PRICE_N) -> DataFrame:
    me = market_events(t, p).where(F.col("get_in_price") > 0)
    order = desc("get_in_price") + asc("event_id")
    rows = top_then_expand(me, order, n, t.event_venues).join(t.venues, "venue_slug")
    return (rows.select("event_id", "title", "category_type", "event_category_name", "venue_name", "city",
                        "state", "country", "get_in_price", "stats_total_quantity", "event_utc_datetime")
            .orderBy(*order, *asc("venue_name", "city", "state", "country")).limit(n))


# O04
def top_by_quantity(t, p: Params, n: int = TOP_QUANTITY_N) -> DataFrame:
    me = market_events(t, p)
    order = desc("stats_total_quantity") + asc("event_id")
    rows = top_then_expand(me, order, n, t.event_venues).join(t.venues, "venue_slug")
    return (rows.select("event_id", "title", "category_type", "event_category_name", "venue_name", "city",
                        "state", "stats_total_quantity", "get_in_price", "event_utc_datetime")
            .orderBy(*order, *asc("venue_name", "city", "state")).limit(n))


def _movement_rows(t, p: Params) -> DataFrame:
    w = for_run(t.windows, p).where(F.col("insufficient_data") == F.lit(False))
    return w.drop("run_id").join(market_events(t, p).select("event_id", "title", "category_type", "event_utc_datetime", "get_in_price"), "event_id")


# O05 / O06
def top_movement(t, p: Params, days: int, n: int = TOP_MOVEMENT_N) -> DataFrame:
    rows = (_movement_rows(t, p).where(F.col("window_days") == F.lit(days))
            .withColumn("_abs", F.abs("raw_change")))
    return (rows.orderBy(*desc("_abs"), *asc("event_id", "percent_change", "direction")).limit(n)
            .select("event_id", "title", "category_type", "direction", "percent_change", "raw_change",
                    "get_in_price", "event_utc_datetime"))


# O07
def zero_price_events(t, p: Params) -> DataFrame:
    rows = (market_events(t, p).where(F.col("get_in_price") == F.lit(0.0))
            .join(t.event_venues, "event_id").join(t.venues, "venue_slug"))
    return (rows.select("event_id", "title", "category_type", "event_category_name", "venue_name", "city",
                        "state", "stats_total_quantity", "is_past_with_no_pricing", "forecast_is_available",
                        "event_utc_datetime")
            .orderBy(*asc("event_utc_datetime", "event_id", "venue_name")))


def stale_predicate(p: Params):
    return F.col("stats_last_updated_at") < as_of_lit(p) - F.make_dt_interval(F.lit(0), F.lit(p.stale_hours))


# O08
def stale_stats(t, p: Params) -> DataFrame:
    rows = market_events(t, p).where(stale_predicate(p))
    return (rows.select("event_id", "title", "category_type", "stats_last_updated_at",
                        hours_between("stats_last_updated_at", as_of_lit(p)).alias("hours_since_update"),
                        "get_in_price", "event_utc_datetime")
            .orderBy(*asc("stats_last_updated_at", "event_id")))


def real_forecast(p: Params):
    return is_real_forecast("forecast_is_available", "forecast_value", p.sentinels)


# O09
def forecast_available(t, p: Params) -> DataFrame:
    rows = market_events(t, p).where(real_forecast(p))
    return (rows.select("event_id", "title", "category_type", "event_category_name", "forecast_value",
                        "forecast_layover_text", "get_in_price", "stats_total_quantity", "event_utc_datetime")
            .orderBy(*desc("forecast_value"), *asc("event_id")))


def pct(num, den, digits=1):
    return round_half_away(F.lit(100.0) * F.col(num).cast("double") / F.col(den).cast("double"), digits)


# O10
def forecast_coverage(t, p: Params) -> DataFrame:
    real = F.when(real_forecast(p), F.lit(1)).otherwise(F.lit(0))
    return (market_events(t, p).groupBy("category_type")
            .agg(F.count(F.lit(1)).alias("total_events"), F.sum(real).alias("forecast_available"))
            .withColumn("pct_with_forecast", pct("forecast_available", "total_events"))
            .orderBy(*desc("pct_with_forecast"), *asc("category_type")))


# O11
def median_price_by_category(t, p: Params) -> DataFrame:
    me = market_events(t, p).where(F.col("get_in_price") > 0)
    st = grouped_price_stats(me, ["category_type", "event_category_name"], median=p.median, small_groups=0)
    return (st.select("category_type", "event_category_name",
                      F.col("_count").alias("event_count"),
                      round_half_away("_median", 2).alias("median_get_in_price"),
                      avg_from_cents().alias("avg_get_in_price"),
                      F.col("_min").alias("min_price"), F.col("_max").alias("max_price"))
            .orderBy(*desc("median_get_in_price"), *asc("category_type", "event_category_name")))


# O12
def median_price_by_venue(t, p: Params, n: int = TOP_VENUE_N, min_events: int = VENUE_MIN_EVENTS) -> DataFrame:
    keys = ["city", "state", "country", "venue_name"]
    rows = (market_events(t, p).where(F.col("get_in_price") > 0)
            .select("event_id", "get_in_price")
            .join(t.event_venues, "event_id").join(t.venues.select("venue_slug", *keys), "venue_slug"))
    rows = written(rows.select("event_id", "get_in_price", *keys), "venue-prices")  # read by both aggregates
    st = grouped_price_stats(rows, keys, median=p.median)
    ev = rows.groupBy(*keys).agg(F.countDistinct("event_id").alias("event_count"))
    null_safe = [st[k].eqNullSafe(ev[k]) for k in keys]
    out = (st.join(ev.where(F.col("event_count") >= min_events), null_safe)
           .select(*[st[k] for k in keys], "event_count",
                   round_half_away("_median", 2).alias("median_get_in_price"),
                   avg_from_cents().alias("avg_get_in_price")))
    return out.orderBy(*desc("median_get_in_price"), *asc(*keys)).limit(n)


def suspicious_predicate(p: Params):
    return (F.col("insufficient_data") == F.lit(False)) & (F.abs("percent_change") > F.lit(p.suspicious_pct))


# O13
def suspicious_changes(t, p: Params) -> DataFrame:
    rows = _movement_rows(t, p).where(suspicious_predicate(p))
    return (rows.select("event_id", "title", "category_type", "window_days", "direction", "percent_change",
                        "raw_change", "get_in_price", "event_utc_datetime")
            .orderBy(F.abs("percent_change").desc(), *asc("event_id", "window_days")))


# O14
def counts_by_source_file(t, p: Params) -> DataFrame:
    loaded = (t.raw_events.groupBy("source_file")
              .agg(F.countDistinct("event_id").alias("loaded_count")))
    return (loaded.join(t.feed_files.select("source_file", "offset", "current_page_results"), "source_file")
            .select("source_file", "offset", F.col("current_page_results").alias("expected_count"),
                    "loaded_count", (F.col("current_page_results") - F.col("loaded_count")).alias("delta"))
            .orderBy(*asc("offset", "source_file")))
