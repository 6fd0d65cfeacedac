"""Shared building blocks for the report, scoring and check operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.config import Params
from feedlens.session import shared_scratch

# A side joined by broadcast must be measured at or below this many rows.
BROADCAST_MAX_ROWS = 1_000_000


def for_run(df: DataFrame, p: Params) -> DataFrame:
    """Snapshot facts hold one row per (run, event); keep the requested run.
    Facts are stored partitioned by run_id, so this prunes partitions."""
    return df.where(F.col("run_id") == F.lit(p.run_id)) if p.run_id else df


def market_events(t, p: Params) -> DataFrame:
    """Snapshot rows of the run joined to the event dimension (1:1 per event); tables that hold them joined are not joined again."""
    return for_run(t.market, p).join(t.events, "event_id") if t.market_events is None else t.market_events


def asc(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def desc(*cols: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


# Candidates looked up in a bridge first, as a multiple of the keys wanted.
TOP_CANDIDATES = 10


def top_then_expand(ranked: DataFrame, order: list[Column], n: int, bridge: DataFrame,
                    key: str = "event_id") -> DataFrame:
    """Top-n rows of ``ranked`` joined to a fan-out ``bridge`` on ``key``.

    Every output row of the joined top-n comes from one of the first n keys (in
    ``order``) that have at least one bridge row, so: keep keys
    with a partner, take n keys (a bounded TakeOrderedAndProject), and join
    only those n keys (a broadcast of at most n rows) back to the bridge.

    The first rows in ``order`` are looked up in the bridge by themselves, so neither side is
    shuffled. Only if fewer than n of them have a partner are all rows semi-joined to the bridge."""
    most = TOP_CANDIDATES * n
    first = written(ranked.orderBy(*order).limit(most), "top-candidates")
    partners = written(bridge.select(key).join(F.broadcast(first.select(key).distinct()), key, "left_semi").distinct(), "top-partners")
    with_partner = first.join(F.broadcast(partners), key, "left_semi")
    if first.count() == most and with_partner.limit(n).count() < n:
        with_partner = ranked.join(bridge.select(key), key, "left_semi")
    top = with_partner.orderBy(*order).limit(n)
    return bridge.join(F.broadcast(top), key)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder named by spark.checkpoint.dir and
    read back, for a result that several branches of a query read: its source
    is expanded once, the planner knows its true size, and a lost executor does
    not cost a recomputation. This runs a job while the query is built."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small_side(big: DataFrame, small: DataFrame, on, how: str = "inner",
                    max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` to a side whose size is only known after it is computed
    (an aggregate such as per-category medians).

    The side is written once and counted from its files' footers; it is
    broadcast only when the count is within ``max_rows``. Beyond that the join
    stays a shuffle join, where adaptive execution splits skewed partitions."""
    side = written(small, "small-side")
    if side.count() <= max_rows:
        side = F.broadcast(side)
    return big.join(side, on, how)
