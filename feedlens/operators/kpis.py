"""Headline KPIs (K01-K06); each is a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.config import Params
from feedlens.operators.common import asc, desc, for_run, market_events
from feedlens.operators.reports import pct, real_forecast, stale_predicate, suspicious_predicate


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# K01
def kpi_totals(t, p: Params) -> DataFrame:
    return (_count(t.events, "total_events")
            .crossJoin(_count(t.venues, "total_venues"))
            .crossJoin(_count(t.performers, "total_performers"))
            .crossJoin(_count(t.feed_files, "total_files")))


# K02
def kpi_zero_stale(t, p: Params) -> DataFrame:
    m = for_run(t.market, p)
    return m.agg(F.count_if(F.col("get_in_price") == F.lit(0.0)).alias("zero_price_events"),
                 F.count_if(stale_predicate(p)).alias("stale_events"))


# K03
def kpi_forecast_pct(t, p: Params) -> DataFrame:
    m = for_run(t.market, p)
    return (m.agg(F.sum(F.when(real_forecast(p), F.lit(1)).otherwise(F.lit(0))).alias("_real"),
                  F.count(F.lit(1)).alias("_n"))
            .select(pct("_real", "_n").alias("forecast_pct")))


# K04
def kpi_suspicious_events(t, p: Params) -> DataFrame:
    w = for_run(t.windows, p).where(suspicious_predicate(p))
    return w.agg(F.countDistinct("event_id").alias("suspicious_events"))


# K05
def kpi_leaders(t, p: Params) -> DataFrame:
    cat = (t.events.groupBy("category_type").agg(F.count(F.lit(1)).alias("top_category_events"))
           .orderBy(*desc("top_category_events"), *asc("category_type")).limit(1)
           .withColumnRenamed("category_type", "top_category"))
    city = (t.event_venues.join(t.venues, "venue_slug").groupBy("city", "state")
            .agg(F.countDistinct("event_id").alias("top_city_events"))
            .orderBy(*desc("top_city_events"), *asc("city", "state")).limit(1)
            .select(F.col("city").alias("top_city"), F.col("state").alias("top_city_state"), "top_city_events"))
    price = (market_events(t, p).where(F.col("get_in_price") > 0)
             .orderBy(*desc("get_in_price"), *asc("event_id")).limit(1)
             .select(F.col("title").alias("top_price_title"), F.col("get_in_price").alias("top_price")))
    return cat.crossJoin(city).crossJoin(price)


# K06
def kpi_dq_fails(dq: DataFrame) -> DataFrame:
    return dq.agg(F.count_if((F.col("status") == F.lit("FAIL"))
                             & F.col("severity").isin("ERROR", "WARNING")).alias("dq_fails"))
