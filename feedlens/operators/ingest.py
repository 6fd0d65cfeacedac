"""Target-table builders (S10-S16) over parsed, exploded events.

``build_batch`` turns one delivery of pages into the nine batch tables,
already deduplicated inside the batch by the same rules used to merge them
into the stored tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.config import WINDOW_DAYS
from feedlens.functions.columns import file_key, offset_from_name
from feedlens.operators.common import written
from feedlens.operators.merge import (EVENT_RULES, FIRST_ORD, LAST_ORD, PERFORMER_RULES, VENUE_RULES,
                                      combine, first_wins, ordinal)
from feedlens.sources import feed


def _ord_out(df: DataFrame, keep: bool) -> DataFrame:
    return df if keep else df.drop("_ord")


def _truthy(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


@dataclass
class Batch:
    pages: DataFrame            # parsed pages (all)
    headers: DataFrame
    events_all: DataFrame       # parsed events incl. bad ones
    loaded: DataFrame           # loadable events with ordinal
    run_id: Column
    loaded_at: Column

    # S02/S03/S09 quarantines
    def quarantine_files(self) -> DataFrame:
        return feed.quarantined_pages(self.pages)

    def quarantine_events(self) -> DataFrame:
        return feed.quarantined_events(self.events_all)

    def _with_ord(self, df: DataFrame) -> DataFrame:
        return df.withColumn(FIRST_ORD, F.col("_ord")).withColumn(LAST_ORD, F.col("_ord"))

    # S10
    def events(self) -> DataFrame:
        rows = self.loaded.select(
            "event_id", "title", "category_type", "event_category_name",
            F.col("event_datetime_ts").alias("event_datetime"),
            F.col("event_datetime").alias("event_datetime_raw"),
            "event_timezone",
            F.col("event_utc_datetime_ts").alias("event_utc_datetime"),
            F.col("date").alias("date_display"),
            self.loaded_at.alias("first_seen_at"), self.loaded_at.alias("last_seen_at"), "_ord")
        return combine(self._with_ord(rows).drop("_ord"), EVENT_RULES)

    # S11
    def performers(self) -> DataFrame:
        rows = (self.loaded.where(_truthy("performer_slug") & _truthy("performer"))
                .select("performer_slug", F.col("performer").alias("performer_name"),
                        self.loaded_at.alias("first_seen_at"), self.loaded_at.alias("last_seen_at"), "_ord"))
        return combine(self._with_ord(rows).drop("_ord"), PERFORMER_RULES)

    # S12
    def venues(self) -> DataFrame:
        rows = (self.loaded.where(_truthy("venue_slug") & _truthy("venue"))
                .select("venue_slug", F.col("venue").alias("venue_name"), "city", "state", "country",
                        self.loaded_at.alias("first_seen_at"), self.loaded_at.alias("last_seen_at"), "_ord"))
        return combine(self._with_ord(rows).drop("_ord"), VENUE_RULES)

    # S13
    def event_performers(self) -> DataFrame:
        return (self.loaded.where(_truthy("performer_slug") & _truthy("performer"))
                .select("event_id", "performer_slug").distinct())

    def event_venues(self) -> DataFrame:
        return (self.loaded.where(_truthy("venue_slug") & _truthy("venue"))
                .select("event_id", "venue_slug").distinct())

    # S14
    def market(self, keep_ord: bool = False) -> DataFrame:
        rows = self.loaded.select(
            F.concat_ws(":", self.run_id, F.col("event_id").cast("string")).alias("state_id"),
            self.run_id.alias("run_id"), "event_id", "source_file",
            "get_in_price",
            F.col("stats_total_quantity_of_tickets").alias("stats_total_quantity"),
            F.col("stats_last_updated_at_ts").alias("stats_last_updated_at"),
            "forecast_is_available", "forecast_value", "forecast_layover_text", "forecast_hover_text",
            "is_past_with_no_pricing", "mock_data_point", "disable_click_through",
            self.loaded_at.alias("loaded_at"), "_ord")
        return _ord_out(first_wins(rows, ["state_id"], "_ord"), keep_ord)

    # S15
    def windows(self, keep_ord: bool = False) -> DataFrame:
        per = F.explode(F.array(*[
            F.struct(F.lit(d).alias("window_days"), F.col(f"{d}day_price_change").alias("m"))
            for d in WINDOW_DAYS])).alias("w")
        rows = (self.loaded.select("event_id", "_ord", self.run_id.alias("run_id"), per)
                .where(F.size("w.m") > 0)   # absent, null and {} emit no row
                .select(
                    F.concat_ws(":", "run_id", F.col("event_id").cast("string"),
                                F.col("w.window_days").cast("string")).alias("window_id"),
                    "run_id", "event_id",
                    F.col("w.window_days").cast("int").alias("window_days"),
                    F.col("w.m")["direction"].alias("direction"),
                    F.col("w.m")["percent"].try_cast("double").alias("percent_change"),
                    F.col("w.m")["raw"].try_cast("double").alias("raw_change"),
                    F.coalesce(F.col("w.m")["insufficient_data"].try_cast("boolean"),
                               F.lit(False)).alias("insufficient_data"),
                    "_ord"))
        return _ord_out(first_wins(rows, ["window_id"], "_ord"), keep_ord)

    # S16
    def raw_archive(self, keep_ord: bool = False) -> DataFrame:
        rows = self.loaded.select(
            F.concat_ws(":", file_key("source_file"), F.col("event_id").cast("string")).alias("raw_id"),
            self.run_id.alias("run_id"), "source_file",
            offset_from_name("source_file").alias("source_offset"),
            "event_id", F.col("event_text").alias("raw_json"),
            self.loaded_at.alias("loaded_at"), "_ord")
        return _ord_out(first_wins(rows, ["raw_id"], "_ord"), keep_ord)


def settled(batch: Batch, fields: tuple[str, ...] = ()) -> Batch:
    """``batch`` with its pages' checks and of its events the outcome and ``fields``, parsed in one pass and written, for queries with
    several outputs: each of them would parse all pages again. The page texts are not kept and the headers still come from them.

    A row is written per event, and one for a page without events; a page's first row stands for the page."""
    said = ("is_corrupt", "status", "reason", "valid")
    texts = feed.parsed_once(batch.pages.select("source_file", F.struct(*said).alias("page"), "valid", "events_text"),
                             _texts=F.when(F.col("valid"), feed.page_event_texts(F.col("events_text"))))
    rows = texts.select("source_file", "page", F.posexplode_outer("_texts").alias("pos", "event_text"))
    rows = written(feed.parse_events(rows, ("page",)).select("source_file", "page", "pos", "id", "id_text", "bad_reason", *fields), "settled")
    events_all = rows.where(F.col("pos").isNotNull()).drop("page")
    loaded = events_all.where(F.col("bad_reason").isNull()).withColumns(
        {"event_id": F.col("id"), "_ord": ordinal(batch.loaded_at, F.col("source_file"), F.col("pos"))})
    return replace(batch, pages=rows.where(F.col("pos").isNull() | (F.col("pos") == 0)).select("source_file", "page.*"),
                   events_all=events_all, loaded=loaded)


def replay_batch(archive: DataFrame, ntz: bool = False) -> Batch:
    """The event tables of archived events (``raw_archive(keep_ord=True)`` rows, of any runs) as a Batch, parsed
    again from their payloads: after a change of rules, or where tables were lost.

    Runs, load times and places are those of the archived load, so the rebuilt
    tables equal the loaded ones. The archive keeps an event's first payload per page file;
    what a page held beside its events is not in it, so pages and headers
    are empty."""
    kept = ("run_id", "loaded_at", "_ord")
    rows = archive.select("source_file", F.col("_ord")["pos"].alias("pos"), F.col("raw_json").alias("event_text"), *kept)
    events_all = feed.parse_events(rows, kept)
    no_pages = feed.parse_pages(rows.limit(0).select("source_file", F.col("event_text").alias("value")))
    return Batch(pages=no_pages, headers=feed.page_headers(no_pages, F.lit(""), F.current_timestamp()), events_all=events_all,
                 loaded=feed.loadable_events(events_all, ntz), run_id=F.col("run_id"), loaded_at=F.col("loaded_at"))


#: Payload fields as variant types: what an archived payload says, whatever the text's layout.
PAYLOAD_FIELDS = {"id": "bigint", "title": "string", "performer_slug": "string", "venue_slug": "string", "event_datetime": "string",
                  "category_type": "string", "stats_total_quantity_of_tickets": "bigint"}


def read_payload(raw_json: Column, fields: dict[str, str] | None = None) -> Column:
    """A struct of payload ``fields`` (name -> type); null where a payload lacks one or holds another type, or is no JSON."""
    payload = F.try_parse_json(raw_json)
    return F.struct(*[F.try_variant_get(payload, f"$.{name}", kind).alias(name) for name, kind in (fields or PAYLOAD_FIELDS).items()])


def build_batch(pages: DataFrame, run_id: str, loaded_at, ntz: bool = False) -> Batch:
    """Parse a frame of (source_file, value) pages into a Batch."""
    return parsed_batch(feed.parse_pages(pages), run_id, loaded_at, ntz)


def parsed_batch(parsed: DataFrame, run_id: str, loaded_at, ntz: bool = False) -> Batch:
    """A Batch of pages that ``feed.parse_pages`` has parsed."""
    run_col = F.lit(run_id)
    ts_col = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    ts_col = ts_col.cast("timestamp_ntz" if ntz else "timestamp")
    events_all = feed.parse_events(feed.explode_events(parsed))
    loaded = (feed.loadable_events(events_all, ntz)
              .withColumn("_ord", ordinal(ts_col, F.col("source_file"), F.col("pos"))))
    return Batch(pages=parsed, headers=feed.page_headers(parsed, run_col, ts_col),
                 events_all=events_all, loaded=loaded, run_id=run_col, loaded_at=ts_col)
