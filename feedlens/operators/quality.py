"""Data-quality suite.

Checks are declared once (name, severity, source table, predicate, what a
sample shows). Checks sharing a source table are counted in ONE aggregation pass over it
(``count_if`` per check), and their failing rows are sampled in one more: each row explodes
into the checks it fails, and a rank per check is cut at the sample's size in every task
before the shuffle. Counts and samples of disjoint parts of a table merge (``merge_states``).

PASS iff the count is at most the check's threshold. ``dq_suite`` runs its
checks when it is called: one that fails to run is counted -1 with its error and takes no other with it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.config import DQ_SAMPLE_ROWS, PAGE_STATUS_OK, SEVERITY_RANK, Params
from feedlens.operators.common import for_run, written
from feedlens.operators.reports import stale_predicate, suspicious_predicate

OFFSET_BUCKET = 1 << 20  # offsets per bucket in the two-level gap scan


@dataclass(frozen=True)
class RowCheck:
    """A check counted as rows of ``source`` matching ``predicate``.

    A sample shows ``before``, then ``of_event`` of the row's event, then ``after``; without
    any, its item."""
    key: str
    name: str
    severity: str
    source: str                      # a name of SOURCES
    predicate: Callable[[Params], Column]
    item: str                        # column identifying a failing row
    first: Callable[[], Column] | None = None  # a number, smallest first, that orders a sample; else the item's
    before: tuple[str, ...] = ()     # SQL expressions of the source
    of_event: tuple[str, ...] = ()   # columns of events
    after: tuple[str, ...] = ()
    weight: str | None = None        # what a failing row counts, if not 1
    threshold: int = 0


def _sign_mismatch(p):
    d, r = F.col("direction"), F.col("raw_change")
    ok = ((d == "up") & (r > 0)) | ((d == "down") & (r < 0)) | ((d == "flat") & (r == 0))
    return (F.col("insufficient_data") == F.lit(False)) & ~ok


def _sentinel(p):
    return F.col("forecast_value").isin(*[float(s) for s in p.sentinels])


def _cents(column: str) -> str:
    return f"cast({column} as decimal(38,2))"


CHANGE = ("event_id", "window_days", "direction", _cents("raw_change"), _cents("percent_change"))

ROW_CHECKS: list[RowCheck] = [
    RowCheck("dq_feed_status", "feed_status_success", "ERROR", "feed_files",
             lambda p: F.col("feed_status") != F.lit(PAGE_STATUS_OK), "source_file", before=("source_file", "feed_status")),
    RowCheck("dq_feed_metadata", "feed_files_have_metadata", "ERROR", "feed_files",
             lambda p: F.col("total_db_matches").isNull(), "source_file"),
    RowCheck("dq_page_count_reconcile", "pagination_record_count_matches", "WARNING", "page_loads",
             lambda p: F.col("current_page_results").isNotNull() & (F.col("loaded") != F.col("current_page_results")),
             "source_file", before=("source_file", "current_page_results", "loaded")),
    RowCheck("dq_offset_gaps", "pagination_offset_gaps", "WARNING", "page_order",
             lambda p: F.col("next_offset").isNotNull() & F.col("limit_per_page").isNotNull()
             & ((F.col("next_offset") - F.col("offset")) != F.col("limit_per_page")),
             "offset", before=("`offset`", "next_offset", "limit_per_page", "next_offset - `offset`")),
    RowCheck("dq_id_present", "event_id_present", "ERROR", "raw_events",
             lambda p: F.col("event_id").isNull(), "raw_id"),
    RowCheck("dq_id_unique", "event_id_unique_in_events_table", "ERROR", "event_copies",
             lambda p: F.col("more") > 0, "event_id", before=("event_id", "more"), weight="more"),
    RowCheck("dq_missing_performer", "performer_slug_present", "WARNING", "raw_links",
             lambda p: F.col("has_performer").isNull(), "raw_id"),
    RowCheck("dq_missing_venue", "venue_slug_present", "WARNING", "raw_links",
             lambda p: F.col("has_venue").isNull(), "raw_id"),
    RowCheck("dq_datetime_parse", "event_datetime_parseable", "ERROR", "events",
             lambda p: F.col("event_datetime").isNull() & F.col("event_datetime_raw").isNotNull(), "event_id",
             before=("event_id", "event_datetime_raw")),
    RowCheck("dq_utc_parse", "event_utc_datetime_parseable", "ERROR", "events",
             lambda p: F.col("event_utc_datetime").isNull(), "event_id", before=("event_id", "title")),
    RowCheck("dq_time_consistency", "event_datetime_utc_consistency", "WARNING", "events",
             lambda p: F.col("event_datetime").isNotNull() & F.col("event_utc_datetime").isNotNull()
             & (F.abs(F.timestamp_diff("MICROSECOND", "event_datetime", "event_utc_datetime"))
                > F.lit(86400 * 1_000_000)), "event_id",
             before=("event_id", "title", "event_datetime", "event_utc_datetime",
                     "cast(abs(timestampdiff(MICROSECOND, event_datetime, event_utc_datetime)) / 3600000000 as decimal(38,2))")),
    RowCheck("dq_updated_parse", "stats_last_updated_at_parseable", "ERROR", "market",
             lambda p: F.col("stats_last_updated_at").isNull(), "state_id"),
    RowCheck("dq_price_present", "get_in_price_numeric", "ERROR", "market",
             lambda p: F.col("get_in_price").isNull(), "state_id"),
    RowCheck("dq_price_zero", "get_in_price_zero_flagged", "WARNING", "market",
             lambda p: F.col("get_in_price") == F.lit(0.0), "state_id", before=("event_id",), of_event=("title", "category_type")),
    RowCheck("dq_quantity_negative", "ticket_quantity_non_negative", "ERROR", "market",
             lambda p: F.col("stats_total_quantity") < 0, "state_id"),
    RowCheck("dq_direction_sign", "price_change_direction_sign_match", "WARNING", "windows",
             _sign_mismatch, "window_id", before=CHANGE),
    RowCheck("dq_insufficient_nonzero", "price_change_insufficient_data_handled", "INFO", "windows",
             lambda p: (F.col("insufficient_data") == F.lit(True))
             & ((F.col("raw_change") != 0) | (F.col("percent_change") != 0)), "window_id", before=(*CHANGE[:2], *CHANGE[3:])),
    RowCheck("dq_suspicious_change", "suspicious_large_price_change", "WARNING", "windows",
             suspicious_predicate, "window_id", lambda: -F.abs("percent_change"), of_event=("title",),
             after=("window_days", "direction", _cents("percent_change"), _cents("raw_change"))),
    RowCheck("dq_sentinel_available", "forecast_sentinel_not_treated_as_prediction", "WARNING", "market",
             lambda p: (F.col("forecast_is_available") == F.lit(True)) & _sentinel(p), "state_id", of_event=("title",),
             after=(_cents("forecast_value"), "forecast_is_available")),
    RowCheck("dq_unavailable_value", "forecast_unavailable_has_sentinel", "INFO", "market",
             lambda p: (F.col("forecast_is_available") == F.lit(False)) & ~_sentinel(p)
             & F.col("forecast_value").isNotNull(), "state_id"),
    RowCheck("dq_stale", "stats_last_updated_stale", "WARNING", "market", stale_predicate, "state_id",
             lambda: F.unix_micros(F.col("stats_last_updated_at").cast("timestamp")), of_event=("title",), after=("stats_last_updated_at",)),
    RowCheck("dq_mock_flag", "mock_data_points_present", "WARNING", "market",
             lambda p: F.col("mock_data_point") != 0, "state_id", of_event=("title",), after=("mock_data_point",)),
]

# Report order of the 22 checks.
SUITE_ORDER = [c.key for c in ROW_CHECKS]
ROW_BY_KEY = {c.key: c for c in ROW_CHECKS}


def check_meta(key: str) -> tuple[str, str]:
    return ROW_BY_KEY[key].name, ROW_BY_KEY[key].severity


# ---- sources needing a join / window ------------------------------------------------

def page_loads(t) -> DataFrame:
    """Pages with their declared result count and the events archived for
    them; pages with no archived event count as 0 loaded (left join)."""
    loaded = t.raw_events.groupBy("source_file").agg(F.count("event_id").alias("loaded"))
    return (t.feed_files.select("source_file", "current_page_results")
            .join(loaded, "source_file", "left").withColumn("loaded", F.coalesce("loaded", F.lit(0))))


FEED_WINDOW = ["date_filter_start", "date_filter_end", "tab_requested"]


def next_offsets(files: DataFrame, bucket: int = OFFSET_BUCKET) -> DataFrame:
    """LEAD(offset) within each feed window, computed in two levels so that no
    single task sorts an unbounded set: rows are ordered inside fixed offset
    buckets, and each bucket's last row takes the minimum offset of the next
    non-empty bucket from a small per-bucket table."""
    f = (files.where(F.col("offset").isNotNull())
         .select(*FEED_WINDOW, "offset", "limit_per_page", "source_file")
         .withColumn("_b", F.floor(F.col("offset") / F.lit(bucket))))
    inner = Window.partitionBy(*FEED_WINDOW, "_b").orderBy("offset", "limit_per_page", "source_file")
    f = f.withColumn("_next_in", F.lead("offset").over(inner)).alias("f")
    bmin = f.groupBy(*FEED_WINDOW, "_b").agg(F.min("offset").alias("_bmin"))
    outer = Window.partitionBy(*FEED_WINDOW).orderBy("_b")
    bnext = bmin.select(*FEED_WINDOW, "_b", F.lead("_bmin").over(outer).alias("_next_b")).alias("n")
    cond = [F.col(f"f.{c}").eqNullSafe(F.col(f"n.{c}")) for c in FEED_WINDOW + ["_b"]]
    return (f.join(bnext, cond, "left")
            .select(*[F.col(f"f.{c}") for c in FEED_WINDOW + ["offset", "limit_per_page", "source_file"]],
                    F.coalesce(F.col("f._next_in"), F.col("n._next_b")).alias("next_offset")))


def event_copies(t) -> DataFrame:
    """Event ids with the rows beyond the first (a null id's rows all count)."""
    n = t.events.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("event_id", (F.col("n") - F.col("event_id").isNotNull().cast("int")).alias("more"))


def raw_links(t, keys: list[str]) -> DataFrame:
    """Archived events with has_performer, has_venue (null: no bridge row), as the checks ``keys`` ask. A
    bridge is reduced to its distinct event ids first (map-side), so an event
    with many partners adds one row to the shuffle, not many."""
    out = t.raw_events.select("event_id", "raw_id")
    for key, flag, bridge in (("dq_missing_performer", "has_performer", t.event_performers), ("dq_missing_venue", "has_venue", t.event_venues)):
        if key in keys:
            out = out.join(bridge.select("event_id").distinct().withColumn(flag, F.lit(True)), "event_id", "left")
    return out


#: source name -> frame of (tables, params, the keys of the checks that read it)
SOURCES: dict[str, Callable[..., DataFrame]] = {
    "feed_files": lambda t, p, keys: t.feed_files,
    "raw_events": lambda t, p, keys: t.raw_events,
    "events": lambda t, p, keys: t.events,
    "market": lambda t, p, keys: for_run(t.market, p),
    "windows": lambda t, p, keys: for_run(t.windows, p),
    "page_loads": lambda t, p, keys: page_loads(t),
    "page_order": lambda t, p, keys: next_offsets(t.feed_files),
    "event_copies": lambda t, p, keys: event_copies(t),
    "raw_links": lambda t, p, keys: raw_links(t, keys),
}


def _by_source(keys: list[str]) -> dict[str, list[RowCheck]]:
    out: dict[str, list[RowCheck]] = {}
    for k in keys:
        out.setdefault(ROW_BY_KEY[k].source, []).append(ROW_BY_KEY[k])
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- counts and samples -----------------------------------------------------------------

def check_counts(t, p: Params, keys: list[str]) -> DataFrame:
    """(check_name, affected_count): one aggregation pass per source."""
    parts = []
    for source, checks in _by_source(keys).items():
        df = SOURCES[source](t, p, [c.key for c in checks])
        counted = [(F.coalesce(F.sum(F.when(c.predicate(p), F.col(c.weight))), F.lit(0)) if c.weight else F.count_if(c.predicate(p))).alias(c.name)
                   for c in checks]
        parts.append(df.agg(*counted).unpivot([], [c.name for c in checks], "check_name", "affected_count"))
    return _union(parts)


SAMPLE_ORDER = ["by_number", "by_id", "item", "event_id"]


def check_samples(t, p: Params, keys: list[str], n: int = DQ_SAMPLE_ROWS) -> DataFrame:
    """Up to ``n`` failing rows of each check: check_name, nth (from 1), the columns that order them, before, after.

    The largest changes and the oldest rows first, else the smallest items (numbers by size).
    A row explodes into the checks it fails; the rank's limit cuts
    each task's rows to ``n`` a check before they are shuffled."""
    parts = []
    for source, checks in _by_source(keys).items():
        df = SOURCES[source](t, p, [c.key for c in checks])

        def row(c: RowCheck) -> Column:
            item = F.col(f"`{c.item}`").cast("string")
            texts = lambda own: F.array(*[F.expr(x).cast("string") for x in own]).cast("array<string>")
            number = F.nanvl(c.first().cast("double"), F.lit(float("-inf"))) if c.first else F.lit(None).cast("double")
            event = F.col("event_id").cast("bigint") if "event_id" in df.columns else F.lit(None).cast("bigint")
            return F.when(c.predicate(p), F.struct(
                F.lit(c.name).alias("check_name"), number.alias("by_number"), item.try_cast("bigint").alias("by_id"), item.alias("item"),
                event.alias("event_id"), texts(c.before or (() if c.of_event or c.after else (f"`{c.item}`",))).alias("before"),
                texts(c.after).alias("after")))

        failed = df.select(F.explode(F.array_compact(F.array(*map(row, checks)))).alias("r")).select("r.*")
        parts.append(_first(failed, n))
    return _union(parts)


def _first(rows: DataFrame, n: int) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in SAMPLE_ORDER] + [F.concat_ws(",", "before", "after")]
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("check_name").orderBy(*order))).where(F.col("nth") <= n)


def shown_samples(samples: DataFrame, events: DataFrame) -> DataFrame:
    """check_name, nth, item, shown: the sampled rows as text, with what they show of their events.

    ``samples`` holds at most a sample a check, so its event ids are broadcast to the events."""
    wanted = sorted({f for c in ROW_CHECKS for f in c.of_event})
    asking = {c.name: c for c in ROW_CHECKS if c.of_event}
    ids = samples.where(F.col("check_name").isin(*asking) & F.col("event_id").isNotNull()).select("event_id").distinct()
    own = (events.select("event_id", *wanted).join(F.broadcast(ids), "event_id", "left_semi")
           .groupBy("event_id").agg(F.min(F.struct(*wanted)).alias("e")))
    fields = F.array().cast("array<string>")
    for name, c in asking.items():
        fields = F.when(F.col("check_name") == name, F.array(*[F.col("e")[f].cast("string") for f in c.of_event])).otherwise(fields)
    text = F.array_join(F.concat("before", fields, "after"), ", ", "NULL")
    return samples.join(own, "event_id", "left").select("check_name", "nth", "item", F.concat(F.lit("("), text, F.lit(")")).alias("shown"))


def merge_states(counts: DataFrame, samples: DataFrame, n: int = DQ_SAMPLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Counts and samples of disjoint parts of the tables as those of the whole: counts add up and samples keep their first ``n`` rows."""
    return counts.groupBy("check_name").agg(F.sum("affected_count").alias("affected_count")), _first(samples.drop("nth"), n)


# ---- runner ---------------------------------------------------------------------------

def _map(of: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in of.items() for x in kv])


def _finish(counts: DataFrame, thresholds: Mapping[str, int] | None = None) -> DataFrame:
    limits = {c.name: c.threshold for c in ROW_CHECKS} | dict(thresholds or {})
    n, limit = F.col("affected_count"), _map(limits)[F.col("check_name")]
    return counts.select(
        "check_name", _map({c.name: c.severity for c in ROW_CHECKS})[F.col("check_name")].alias("severity"),
        F.when((n >= 0) & (n <= limit), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"), n.cast("bigint").alias("affected_count"))


def _resolves(t, p: Params, key: str) -> bool:
    """Whether the tables have what a check reads."""
    try:
        return bool(check_counts(t, p, [key]).schema)
    except AnalysisException:
        return False


def run_checks(t, p: Params, keys: list[str] | None = None, thresholds: Mapping[str, int] | None = None) -> DataFrame:
    """Counts for the requested checks (default: all 22), one row per check:
    check_name, severity, status, affected_count, as a plan that nothing has run yet.

    ``thresholds`` replace the checks' own, by check name. A check whose table lacks a
    column counts -1; an error while the plan runs ends all (``dq_suite`` isolates it)."""
    keys = keys or SUITE_ORDER
    sound = [k for k in keys if _resolves(t, p, k)]
    broken = [(ROW_BY_KEY[k].name, -1) for k in keys if k not in sound]
    parts = [check_counts(t, p, sound)] if sound else []
    if broken:
        parts.append(t.events.sparkSession.createDataFrame(broken, "check_name string, affected_count bigint"))
    return _finish(_union(parts), thresholds)


def _isolated(build: Callable[[list[str]], DataFrame], keys: list[str], name: str) -> tuple[list[DataFrame], dict[str, str]]:
    """``build`` of the checks ``keys``, written, and the errors of those that fail to run: after a failure each half is tried alone."""
    if not keys:
        return [], {}
    try:
        return [written(build(keys), name)], {}
    except Exception as e:  # whatever a check raises, here or on an executor, is its result
        if len(keys) == 1:
            text = e.getMessage() if hasattr(e, "getMessage") else None
            return [], {ROW_BY_KEY[keys[0]].name: (text or str(e)).strip().split("\n")[0]}
    half = len(keys) // 2
    (a, x), (b, y) = (_isolated(build, part, name) for part in (keys[:half], keys[half:]))
    return a + b, x | y


def check_states(t, p: Params, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame | None, dict[str, str]]:
    """Runs the checks: their counts, the samples of those with a failing row (None if none has), both written, and errors by check name."""
    counted, errors = _isolated(lambda own: check_counts(t, p, own), keys or SUITE_ORDER, "dq-counts")
    failing: set[str] = set()
    if counted:
        failing = {r["check_name"] for r in _union(counted).where("affected_count > 0").collect()}  # a name a check at most
    sampled, more = _isolated(lambda own: check_samples(t, p, own), [k for k in SUITE_ORDER if ROW_BY_KEY[k].name in failing], "dq-samples")
    errors |= more  # a check whose rows cannot be shown has not run
    spark = t.events.sparkSession
    done = _union(counted) if counted else spark.createDataFrame([], "check_name string, affected_count bigint")
    return done.where(~F.col("check_name").isin(*errors)) if errors else done, _union(sampled) if sampled else None, errors


def suite_result(counts: DataFrame, samples: DataFrame | None, events: DataFrame, errors: Mapping[str, str] | None = None,
                 thresholds: Mapping[str, int] | None = None) -> DataFrame:
    """check_name, severity, status, affected_count, details from counts and samples.

    details: on FAIL the sampled rows, joined by "; ", or the error of a check that did not run (affected_count -1); else null."""
    spark = events.sparkSession
    if errors:
        bad = spark.createDataFrame([(name, -1) for name in errors], "check_name string, affected_count bigint")
        counts = counts.unionByName(bad)
    out = _finish(counts, thresholds)
    details = F.lit(None).cast("string")
    if samples is not None:
        text = shown_samples(samples, events).groupBy("check_name").agg(F.array_sort(F.collect_list(F.struct("nth", "shown"))).alias("s"))
        text = text.select("check_name", F.array_join(F.transform("s", lambda x: x["shown"]), "; ").alias("sample"))
        out = out.join(F.broadcast(text), "check_name", "left")  # a row a check
        details = F.col("sample")
    if errors:
        details = F.coalesce(F.concat(F.lit("Check error: "), _map(errors)[F.col("check_name")]), details)
    return out.select("check_name", "severity", "status", "affected_count", F.when(F.col("status") == "FAIL", details).alias("details"))


def dq_suite(t, p: Params, thresholds: Mapping[str, int] | None = None) -> DataFrame:
    """All 22 checks, run now: check_name, severity, status, affected_count, details."""
    counts, samples, errors = check_states(t, p)
    return suite_result(counts, samples, t.events, errors, thresholds)


def failing_rows(t, p: Params, keys: list[str] | None = None, n: int = DQ_SAMPLE_ROWS) -> DataFrame:
    """Drill-down (D23): check_name, item and shown of up to ``n`` failing rows per check, as ``check_samples`` chooses them."""
    keys = [k for k in keys or SUITE_ORDER if _resolves(t, p, k)]
    rows = written(check_samples(t, p, keys, n), "dq-samples")  # bounded: n rows a check
    return shown_samples(rows, t.events).select("check_name", "item", "shown")


def dq_summary(dq: DataFrame) -> DataFrame:
    """Checks and affected rows per (severity, status), and the failing checks with their counts, by name."""
    named = F.when(F.col("status") == "FAIL", F.concat("check_name", F.lit(" ("), F.col("affected_count").cast("string"), F.lit(")")))
    failing = F.array_join(F.array_sort(F.collect_list(named)), "; ")  # at most a name a check
    return dq.groupBy("severity", "status").agg(F.count(F.lit(1)).alias("checks"), F.sum("affected_count").alias("affected"),
                                               F.nullif(failing, F.lit("")).alias("failing"))


def severity_rank():
    rank = None
    for sev, r in SEVERITY_RANK.items():
        cond = F.col("severity") == F.lit(sev)
        rank = F.when(cond, F.lit(r)) if rank is None else rank.when(cond, F.lit(r))
    return rank.otherwise(F.lit(len(SEVERITY_RANK) + 1))


def dq_report(dq: DataFrame) -> DataFrame:
    """Results ranked by severity, PASS before FAIL, larger counts first."""
    return dq.orderBy(severity_rank(), F.col("status").desc(), F.col("affected_count").desc(),
                      F.col("check_name"))
