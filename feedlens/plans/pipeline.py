"""End-to-end batch pipeline: ingest pages -> stored tables -> checks -> outputs.

    store = TableStore(spark, base)            # base on shared storage
    run = ingest_pages(spark, scan_pages(spark, input_dir), store, run_id, ...)
    tables = load_tables(store)
    dq = record_checks(spark, tables, store, run_id, params)
    write_outputs(tables, dq, params, out_dir)
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlens.config import Params
from feedlens.operators import kpis, ledger, quality, reports, scoring
from feedlens.operators.ingest import parsed_batch
from feedlens.operators.merge import (EVENT_RULES, FILE_RULES_LATEST, FILE_RULES_REFERENCE, FIRST_ORD, LAST_ORD,
                                      PERFORMER_RULES, VENUE_RULES, first_wins, insert_if_absent, ordinal, upsert)
from feedlens.operators.sink import write_result_sets
from feedlens.sources import feed
from feedlens.sources.store import TableStore
from feedlens.tables import FeedTables

KEYED = {"events": EVENT_RULES, "performers": PERFORMER_RULES, "venues": VENUE_RULES}
# snapshot facts group by (run_id, key): a report's run filter is then on a
# grouping column, so it is pushed below the dedup and down to the files,
# which are partitioned by run_id
FIRST_WINS = {"market": ["run_id", "state_id"], "windows": ["run_id", "window_id"], "raw_events": ["raw_id"]}
BY_RUN = {"market": ["run_id"], "windows": ["run_id"]}
BRIDGES = ("event_performers", "event_venues")
LOGS = ("page_log", "event_quarantine", "batch_metrics")
FOLDED_AT_ONCE = 4  # tables; listing their deltas and planning leaves most of a cluster idle


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def page_log(batch, run_id: str) -> DataFrame:
    """One row per delivered page: validity, reason, loaded and rejected events.
    Pages are 1/100 of events, and the event counts are pre-aggregated per page."""
    per_page = (batch.events_all.groupBy("source_file")
                .agg(F.count_if(F.col("bad_reason").isNull()).cast("int").alias("events_loaded"),
                     F.count_if(F.col("bad_reason").isNotNull()).cast("int").alias("events_rejected")))
    return (batch.pages.select("source_file", "valid", "reason")
            .join(per_page, "source_file", "left")
            .select(F.lit(run_id).alias("run_id"), "source_file", "valid", "reason",
                    F.coalesce("events_loaded", F.lit(0)).alias("events_loaded"),
                    F.coalesce("events_rejected", F.lit(0)).alias("events_rejected"),
                    batch.loaded_at.alias("loaded_at")))


METRICS = "run_id string, tag string, files_found bigint, files_loaded bigint, events_loaded bigint"


def _metrics_row(spark: SparkSession, metrics: tuple) -> DataFrame:
    """A METRICS row as a literal of the plan: no Python worker reads it."""
    return spark.range(1).select(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(metrics, (c.split() for c in METRICS.split(", ")))])


def write_page_log(batch, store: TableStore, run_id: str, tag: str, log: DataFrame | None = None) -> tuple:
    """Writes the batch's page log (``log``, if its frame is there already) and returns its METRICS row, counted by the write itself.

    The counts are observed in the stage that writes, whose tasks count once each
    however often they are tried; nothing is read again."""
    seen = Observation(f"page-log-{tag}-{time.time_ns()}")
    log = page_log(batch, run_id) if log is None else log
    counted = log.observe(
        seen, F.count(F.lit(1)).alias("files_found"), F.count_if("valid").alias("files_loaded"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("events_loaded"))), F.lit(0)).cast("bigint").alias("events_loaded"))
    store.append_delta("page_log", counted, tag, stub=log)
    n = seen.get
    return run_id, tag, n["files_found"], n["files_loaded"], n["events_loaded"]


def batch_metrics(store: TableStore, run_id: str) -> DataFrame | None:
    """METRICS of the run's batches, one row each: a batch written again counts as the last time."""
    rows = read_table(store, "batch_metrics")
    return None if rows is None else rows.where(F.col("run_id") == F.lit(run_id))


def side_by_side(spark: SparkSession, *jobs: Callable, at_once: int | None = None) -> list:
    """The results of ``jobs``, a thread each (``at_once`` of them at a time), in their order; all have ended before the first error is raised."""
    with ThreadPoolExecutor(at_once or len(jobs)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in begun]


class Delivery:
    """The frames of what a delivery of ``feed.parse_pages`` pages writes, built once and written as often as the pages change.

    Building them costs some ten thousand calls to the JVM, more time than a small batch's work. So a stream builds them once, over a
    place where it stages its batches, and each batch writes the same frames (``write``)."""

    def __init__(self, parsed: DataFrame, run_id: str, loaded_at: datetime):
        self.run_id = run_id
        self.batch = batch = parsed_batch(parsed, run_id, loaded_at)
        # parsed pages/events feed eleven outputs: parse once, spill to disk if needed
        batch.pages = batch.pages.persist(StorageLevel.MEMORY_AND_DISK)
        batch.events_all = batch.events_all.persist(StorageLevel.MEMORY_AND_DISK)
        header_ord = ordinal(batch.loaded_at, F.col("source_file"), F.lit(0))
        self.deltas = {
            "events": batch.events(), "performers": batch.performers(), "venues": batch.venues(),
            "feed_files": batch.headers.withColumn(FIRST_ORD, header_ord).withColumn(LAST_ORD, header_ord),
            "event_performers": batch.event_performers(), "event_venues": batch.event_venues(),
            "market": batch.market(keep_ord=True), "windows": batch.windows(keep_ord=True),
            "raw_events": batch.raw_archive(keep_ord=True),
            "event_quarantine": batch.quarantine_events().withColumn("run_id", F.lit(run_id)),
        }
        self.log = page_log(batch, run_id)

    def write(self, spark: SparkSession, store: TableStore, tag: str) -> None:
        # a small batch's time is that of planning and starting its writes, so they run side by side
        writes = [partial(store.append_delta, name, df, tag, BY_RUN.get(name)) for name, df in self.deltas.items()]
        *_, metrics = side_by_side(spark, *writes, partial(write_page_log, self.batch, store, self.run_id, tag, self.log))
        store.append_delta("batch_metrics", _metrics_row(spark, metrics), tag)

    def unpersist(self) -> None:
        self.batch.pages.unpersist()
        self.batch.events_all.unpersist()


def ingest_pages(spark: SparkSession, pages: DataFrame, store: TableStore, run_id: str,
                 loaded_at: datetime | None = None, tag: str | None = None) -> None:
    """Load one delivery of pages (a frame of (source_file, value)) into the
    store. Work and writes are O(batch): every table receives this batch's
    rows as a delta (deduplicated inside the batch by the table's rule);
    nothing already stored is read or rewritten. The batch's numbers are
    written last, as a delta of the same tag, so a batch that failed midway has none until
    it is loaded again."""
    delivery = Delivery(feed.parse_pages(pages), run_id, loaded_at or _now())
    try:
        delivery.write(spark, store, tag or run_id)
    finally:
        delivery.unpersist()


def read_table(store: TableStore, name: str, keep_ord: bool = False,
               header_policy: str = "latest") -> DataFrame | None:
    """A stored table with its merge rule applied to base + deltas."""
    return _merged(name, store.read_all(name), keep_ord, header_policy)


def _merged(name: str, df: DataFrame | None, keep_ord: bool = False,
            header_policy: str = "latest") -> DataFrame | None:
    if df is None:
        return None
    if name in KEYED or name == "feed_files":
        rules = KEYED.get(name) or (FILE_RULES_LATEST if header_policy == "latest" else FILE_RULES_REFERENCE)
        cols = df.columns
        df = upsert(None, df, rules).select(*cols)
        return df if keep_ord else df.drop(FIRST_ORD, LAST_ORD)
    if name in FIRST_WINS:
        df = first_wins(df, FIRST_WINS[name], "_ord")
        return df if keep_ord else df.drop("_ord")
    if name in BRIDGES:
        return df.distinct()
    return df


def compact(store: TableStore, tables=None) -> None:
    """Fold each table's deltas, once per run. Facts and logs get a further
    part made of the new deltas alone (O(deltas); earlier runs' files stay as
    they are, and readers apply the rule over all parts); the keyed tables
    and bridges, which hold one row per entity, get a new base (O(table))."""
    def fold(name: str) -> None:
        tags = store.delta_tags(name)
        if not tags:
            return
        tag = f"compact-{time.time_ns()}"
        if name in FIRST_WINS or name in LOGS:
            new = _merged(name, store.read_deltas(name).drop("tag"), keep_ord=True)
            store.publish_part(name, new, tag, folded=tags, partition_by=BY_RUN.get(name))
        else:
            store.publish(name, read_table(store, name, keep_ord=True), tag, folded=tags)

    names = tables or (*KEYED, "feed_files", *FIRST_WINS, *BRIDGES, *LOGS)
    side_by_side(store.spark, *[partial(fold, name) for name in names], at_once=FOLDED_AT_ONCE)


def start_run(spark: SparkSession, store: TableStore, run_id: str, started_at: datetime, input_dir: str) -> None:
    store.append_fact("runs", ledger.run_start_row(spark, run_id, started_at, input_dir), ["run_id"])


def ledger_from_metrics(metrics: DataFrame, run_id, started_at, finished_at, input_dir: str) -> DataFrame:
    """The finished-run row from the METRICS rows of a run's batches."""
    total = metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("files_found", "files_loaded", "events_loaded")])
    return ledger.run_ledger_rows(total, run_id, started_at, finished_at, input_dir)


def finish_run(spark: SparkSession, store: TableStore, run_id: str, started_at: datetime,
               input_dir: str) -> DataFrame:
    """W07 from the numbers its batches' writes counted, W09 from the run's page log and event quarantine."""
    finished = F.lit(_now()).cast("timestamp")
    pages = read_table(store, "page_log")
    pages = pages.where(F.col("run_id") == F.lit(run_id)) if pages is not None else None
    if pages is None:
        pages = spark.createDataFrame([], "run_id string, source_file string, valid boolean, reason string, "
                                          "events_loaded int, events_rejected int")
    metrics = batch_metrics(store, run_id)
    if metrics is None:
        metrics = spark.createDataFrame([], METRICS)
    done = ledger_from_metrics(metrics, F.lit(run_id), F.lit(started_at).cast("timestamp"), finished, input_dir)
    bad_files = pages.where(~F.col("valid")).select("source_file", "reason")
    bad_events = read_table(store, "event_quarantine")
    if bad_events is None:
        bad_events = spark.createDataFrame([], "source_file string, reason string, event_id string")
    else:
        bad_events = bad_events.where(F.col("run_id") == F.lit(run_id))
    dq = ledger.ingest_dq_rows(ledger.ingest_dq_reasons(bad_files, bad_events), F.lit(run_id), finished)
    existing_dq = store.read_fact("dq_results")
    store.append_fact("dq_results", insert_if_absent(existing_dq, dq, ["check_id"], F.col("check_id")),
                      ["run_id"])
    store.append_fact("runs", done, ["run_id"])
    return store.read_fact("runs").where(F.col("run_id") == F.lit(run_id)) \
        .where(F.col("status") == F.lit("success"))


def run_batch(spark: SparkSession, pages: DataFrame, store: TableStore, run_id: str,
              input_dir: str = "", loaded_at: datetime | None = None, compact_after: bool = True,
              **kw) -> DataFrame:
    """Whole delivery as one batch: start, ingest, finish, fold deltas."""
    started = loaded_at or _now()
    start_run(spark, store, run_id, started, input_dir)
    ingest_pages(spark, pages, store, run_id, started, **kw)
    done = finish_run(spark, store, run_id, started, input_dir)
    if compact_after:
        compact(store)
    return done


LATEST, ALL_RUNS = "latest", None


def load_tables(store: TableStore, header_policy: str = "latest", run_id: str | None = LATEST) -> FeedTables:
    """The stored tables. Snapshot facts (market, windows) hold one row per run
    and event: by default they are those of the latest successful run, else of
    the run named, or of all runs on request (ALL_RUNS). Without a successful
    run there is nothing to choose by and all are kept."""
    def t(name):
        return read_table(store, name, header_policy=header_policy)

    runs = store.read_fact("runs")
    if run_id == LATEST:
        run_id = latest_run_id(runs)

    def facts(name):
        df = t(name)
        return df if run_id is None or df is None else df.where(F.col("run_id") == F.lit(run_id))

    return FeedTables(
        feed_files=t("feed_files"), raw_events=t("raw_events"), events=t("events"),
        performers=t("performers"), venues=t("venues"),
        event_performers=t("event_performers"), event_venues=t("event_venues"),
        market=facts("market"), windows=facts("windows"),
        dq_results=store.read_fact("dq_results"), runs=runs)


def latest_run_id(runs: DataFrame | None) -> str | None:
    row = None if runs is None else ledger.latest_successful_run(runs).first()  # one scalar
    return row["run_id"] if row else None


def record_checks(spark: SparkSession, tables: FeedTables, store: TableStore, run_id: str,
                  p: Params) -> DataFrame:
    """Run the 22 checks for ``run_id`` and append them to the history, keyed
    by run and check; a repeated run adds later rows, which win on reading."""
    res = quality.dq_suite(tables, p)
    rows = res.select(F.concat_ws(":", F.lit(run_id), "check_name").alias("check_id"),
                      F.lit(run_id).alias("run_id"), "check_name", "severity", "status", "affected_count", "details",
                      F.lit(_now()).cast("timestamp").alias("checked_at"))
    store.append_fact("dq_checks", rows, ["run_id"])
    return rows


def _state_params(p: Params) -> str:
    """What a check's state depends on beside its rows."""
    return f"{p.as_of_sql}|{p.stale_hours}|{p.suspicious_pct}|{p.sentinels}"


def runs_suite(spark: SparkSession, tables: FeedTables, store: TableStore, run_ids: list[str], p: Params,
               thresholds: dict[str, int] | None = None) -> DataFrame:
    """The checks on snapshot facts (market, windows) over all of ``run_ids``, from a state kept per run.

    A run's rows are its own, so counts add up and samples merge: only runs
    without a state of these parameters are read, and their states are
    written. ``tables`` hold the facts of all runs (``load_tables`` with ALL_RUNS). Same columns as ``dq_suite``."""
    keys = [c.key for c in quality.ROW_CHECKS if c.source in ("market", "windows")]
    params = _state_params(p)

    def kept(name):
        rows = store.read_fact(name)
        return None if rows is None else rows.where((F.col("params") == params) & F.col("run_id").isin(*run_ids))

    have = kept("dq_state_counts")
    done = set() if have is None else {r["run_id"] for r in have.select("run_id").distinct().collect()}
    errors: dict[str, str] = {}
    for run in [r for r in dict.fromkeys(run_ids) if r not in done]:
        counts, samples, broken = quality.check_states(tables, replace(p, run_id=run), keys)
        errors |= broken
        if broken:
            continue  # a run whose checks did not all run has no state, and the next call tries it again
        own = {"run_id": F.lit(run), "params": F.lit(params)}
        if samples is not None:
            store.append_fact("dq_state_samples", samples.withColumns(own), ["run_id"])
        store.append_fact("dq_state_counts", counts.withColumns(own), ["run_id"])  # last: it marks the state as whole
    counts, samples = kept("dq_state_counts"), kept("dq_state_samples")
    if counts is None:
        counts = spark.createDataFrame([], "check_name string, affected_count bigint, run_id string, params string")
    if samples is None:
        counts = counts.groupBy("check_name").agg(F.sum("affected_count").alias("affected_count"))
    else:
        # a state cut off before its counts were written leaves samples that the next one repeats
        samples = samples.drop("params").dropDuplicates(["run_id", "check_name", "nth"]).drop("run_id")
        counts, samples = quality.merge_states(counts, samples)
    return quality.suite_result(counts.where(~F.col("check_name").isin(*errors)) if errors else counts, samples, tables.events, errors, thresholds)


def check_history(store: TableStore) -> DataFrame | None:
    """One row per run and check, the one written last."""
    rows = store.read_fact("dq_checks")
    if rows is None:
        return None
    rest = [c for c in rows.columns if c != "check_id"]
    return (rows.groupBy("check_id").agg(F.max_by(F.struct(*rest), "checked_at").alias("_r"))
            .select("check_id", "_r.*").select(*rows.columns))


def dq_with_ingest_rows(tables: FeedTables, dq: DataFrame, run_id: str | None) -> DataFrame:
    """Suite rows plus the run's ingest rows (malformed files / events)."""
    cols = ["check_name", "severity", "status", "affected_count", "details"]
    ingest = tables.dq_results
    if ingest is None:
        return dq.select(*cols)
    if run_id:
        ingest = ingest.where(F.col("run_id") == F.lit(run_id))
    return dq.select(*cols).unionByName(ingest.select(*cols))


def report_builders(tables: FeedTables, dq: DataFrame, p: Params) -> dict:
    t = tables
    dq = dq_with_ingest_rows(tables, dq, p.run_id)
    return {
        "01_events_by_category": lambda: reports.events_by_category(t, p),
        "02_events_by_geography": lambda: reports.events_by_geography(t, p),
        "03_top20_by_get_in_price": lambda: reports.top_by_price(t, p),
        "04_top20_by_ticket_quantity": lambda: reports.top_by_quantity(t, p),
        "05_top20_3day_price_movement": lambda: reports.top_movement(t, p, 3),
        "06_top20_7day_price_movement": lambda: reports.top_movement(t, p, 7),
        "07_zero_price_events": lambda: reports.zero_price_events(t, p),
        "08_stale_stats": lambda: reports.stale_stats(t, p),
        "09_forecast_available_events": lambda: reports.forecast_available(t, p),
        "10_forecast_coverage_by_category": lambda: reports.forecast_coverage(t, p),
        "11_median_price_by_category": lambda: reports.median_price_by_category(t, p),
        "12_median_price_by_city_venue": lambda: reports.median_price_by_venue(t, p),
        "13_suspicious_price_changes": lambda: reports.suspicious_changes(t, p),
        "14_event_counts_by_source_file": lambda: reports.counts_by_source_file(t, p),
        "15_dq_failure_counts": lambda: quality.dq_report(dq),
        "pricing_review_ranked": lambda: scoring.pricing_review(t, p),
        "kpis": lambda: (kpis.kpi_totals(t, p).crossJoin(kpis.kpi_zero_stale(t, p))
                         .crossJoin(kpis.kpi_forecast_pct(t, p)).crossJoin(kpis.kpi_suspicious_events(t, p))
                         .crossJoin(kpis.kpi_leaders(t, p)).crossJoin(kpis.kpi_dq_fails(dq))),
    }


def write_outputs(tables: FeedTables, dq: DataFrame, p: Params, out_dir: str, fmt: str = "csv") -> dict:
    return write_result_sets(report_builders(tables, dq, p), out_dir, fmt)
