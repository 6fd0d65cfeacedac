"""Keyed merges for plain Parquet tables.

Order of "first" and "last" is an ordinal stored with each row:
struct(run timestamp, source file name, position in page). Arrival order of
files or micro-batches never matters, only this ordinal.

Every merge is a groupBy on the key with min_by/max_by (declarative
aggregates with map-side partial aggregation, so a hot key is reduced before
the shuffle) or an anti join; no window collects a key's rows in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.common import BROADCAST_MAX_ROWS, written

FIRST_ORD, LAST_ORD = "_first_ord", "_last_ord"


def ordinal(run_ts: Column, source_file: Column, pos: Column) -> Column:
    return F.struct(run_ts.alias("ts"), source_file.alias("file"), pos.cast("bigint").alias("pos"))


@dataclass(frozen=True)
class MergeRules:
    key: tuple[str, ...]
    latest: tuple[str, ...] = ()        # value of the row with the greatest ordinal
    first: tuple[str, ...] = ()         # value of the row with the smallest ordinal
    first_seen: str | None = "first_seen_at"
    last_seen: str | None = "last_seen_at"
    extra_first: tuple[str, ...] = field(default=())


EVENT_RULES = MergeRules(
    key=("event_id",),
    latest=("title", "category_type", "event_category_name"),
    first=("event_datetime", "event_datetime_raw", "event_timezone", "event_utc_datetime", "date_display"),
)
PERFORMER_RULES = MergeRules(key=("performer_slug",), first=("performer_name",))
VENUE_RULES = MergeRules(key=("venue_slug",), first=("venue_name", "city", "state", "country"))
# feed files: the header keeps its first delivery's counts; lineage columns
# (run_id, loaded_at) follow the latest delivery.
FILE_RULES_REFERENCE = MergeRules(
    key=("file_id",), latest=("run_id", "loaded_at"),
    first=("source_file", "offset", "feed_status", "total_db_matches", "current_page_results", "has_more",
           "limit_per_page", "tab_requested", "date_filter_start", "date_filter_end", "upcoming_count",
           "past_count", "total_count"),
    first_seen=None, last_seen=None)
FILE_RULES_LATEST = MergeRules(
    key=("file_id",),
    latest=("run_id", "loaded_at", "source_file", "offset", "feed_status", "total_db_matches",
            "current_page_results", "has_more", "limit_per_page", "tab_requested", "date_filter_start",
            "date_filter_end", "upcoming_count", "past_count", "total_count"),
    first_seen=None, last_seen=None)


def combine(df: DataFrame, rules: MergeRules) -> DataFrame:
    """Collapse rows sharing the key according to the rules.

    All first values are one struct and all latest ones another, so a key's buffer holds two ordinals and not two a column."""
    first = [*rules.first, *([rules.first_seen] if rules.first_seen else []), FIRST_ORD]
    latest = [*rules.latest, *([rules.last_seen] if rules.last_seen else []), LAST_ORD]
    return (df.groupBy(*rules.key)
            .agg(F.max_by(F.struct(*latest), LAST_ORD).alias("_latest"), F.min_by(F.struct(*first), FIRST_ORD).alias("_first"))
            .select(*rules.key, *[F.col("_latest")[c].alias(c) for c in latest[:-1] if c in rules.latest],
                    *[F.col("_first")[c].alias(c) for c in first[:-1]],
                    *[F.col("_latest")[c].alias(c) for c in latest[:-1] if c not in rules.latest],
                    F.col("_first")[FIRST_ORD].alias(FIRST_ORD), F.col("_latest")[LAST_ORD].alias(LAST_ORD)))


def _broadcastable(keys: DataFrame) -> DataFrame | None:
    """``keys`` written, to be broadcast, or None if they are more than that is allowed for."""
    keys = written(keys, "batch-keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_MAX_ROWS else None


def upsert(target: DataFrame | None, batch: DataFrame, rules: MergeRules,
           small_batch: bool = False) -> DataFrame:
    """Merge a batch into a keyed table.

    With ``small_batch`` the batch's keys are written and counted; if they may
    be broadcast, only target rows whose key occurs in the
    batch are regrouped and the rest pass through a broadcast anti join, so the
    target is never shuffled. Otherwise target and batch are regrouped
    together (one shuffle on the key)."""
    cols = list(rules.key) + [c for c in batch.columns if c not in rules.key]
    if target is None:
        return combine(batch, rules).select(*cols)
    target = target.select(*cols)
    batch = batch.select(*cols)
    keys = _broadcastable(batch.select(*rules.key).distinct()) if small_batch else None
    if keys is None:
        return combine(target.unionByName(batch), rules).select(*cols)
    touched = target.join(keys, list(rules.key), "left_semi")
    untouched = target.join(keys, list(rules.key), "left_anti")
    return untouched.unionByName(combine(touched.unionByName(batch), rules).select(*cols))


def first_wins(df: DataFrame, key: list[str], order: Column | str) -> DataFrame:
    """In-batch dedup: for each key keep the row with the smallest ordinal."""
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.min_by(F.struct(*rest), order_col).alias("_row"))
            .select(*key, "_row.*"))


def insert_if_absent(target: DataFrame | None, batch: DataFrame, key: list[str], order: Column | str,
                     small_batch: bool = False) -> DataFrame:
    """ON CONFLICT DO NOTHING. Rows whose key exists in the target are
    dropped from the batch; within the batch the first ordinal wins. Returns
    the rows to append (the target itself is unchanged)."""
    new = first_wins(batch, key, order)
    if target is None:
        return new
    existing = target.select(*key)
    keys = _broadcastable(new.select(*key)) if small_batch else None
    if keys is not None:  # the (large) target is not shuffled
        existing = existing.join(keys, key, "left_semi")
    return new.join(existing, key, "left_anti")


def latest_snapshot(snapshots: DataFrame, key: str = "event_id", order: str = "loaded_at",
                    tie: str = "run_id") -> DataFrame:
    """The most recent snapshot row per key (max by (loaded_at, run_id))."""
    rest = [c for c in snapshots.columns if c != key]
    return (snapshots.groupBy(key)
            .agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.col(tie))).alias("_row"))
            .select(key, "_row.*"))
