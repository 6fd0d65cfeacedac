"""Page-parsing (S01-S16) and write-semantics (W01-W10) keys over the driver
tables, with their DuckDB oracles.

Pages come from ``driver_pages`` (JSON text built by Spark from the role
views). The oracles never parse JSON: they apply the same modular rules to
the same views, so a match proves the round trip text -> tables."""

from __future__ import annotations

from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.config import Params
from feedlens.functions.columns import as_of_lit, file_key, normalise_ts, offset_from_name
from feedlens.operators import ledger, merge
from feedlens.operators.common import market_events, written
from feedlens.operators.ingest import build_batch, read_payload, replay_batch, settled
from feedlens.operators.quality import dq_suite
from feedlens.operators.sink import sink_result_sets
from feedlens.plans import pipeline
from feedlens.plans.oracle_views import AS_OF, with_views
from feedlens.plans.oracles import KPIS, REPORTS, SCORE_VIEWS, SCORING, detailed_suite_sql, suite_sql
from feedlens.session import pin_utc, shared_scratch
from feedlens.sources import feed
from feedlens.sources.driver import (DRIVER_RUN_ID, driver_page_names, driver_pages, driver_tables, events_view, market_view,
                                     pages_view, performers_view, read_table, venues_view)
from feedlens.sources.store import TableStore
from feedlens.streaming.incremental import incremental_load

NTZ = "timestamp_ntz"


def _batch(spark, sf_dir, p):
    return build_batch(driver_pages(spark, sf_dir, p), DRIVER_RUN_ID, as_of_lit(p), ntz=False)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast(NTZ))
    return df


def _write_pages(spark, sf_dir, p, name) -> str:
    """The feed's pages as files of one flat folder."""
    path = shared_scratch(spark, name)
    feed.write_page_files(driver_pages(spark, sf_dir, p), path)
    return path


# ---- S keys ------------------------------------------------------------------------------------

def s01(spark, sf_dir, p):
    pages = feed.scan_pages(spark, _write_pages(spark, sf_dir, p, "pages"))
    return pages.select("source_file", F.length("value").cast("bigint").alias("n_chars"), F.sha2("value", 256).alias("text_sha256"))


def s02(spark, sf_dir, p):
    return feed.quarantined_pages(_batch(spark, sf_dir, p).pages)


def s03(spark, sf_dir, p):
    return (_batch(spark, sf_dir, p).pages.where(~F.col("is_corrupt"))
            .select("source_file", "status", "valid", "reason"))


def s04(spark, sf_dir, p):
    return _batch(spark, sf_dir, p).events_all.select("source_file", "pos", F.col("id").alias("event_id"))


def s05(spark, sf_dir, p):
    h = _ntz(_batch(spark, sf_dir, p).headers, "loaded_at")
    # dates rendered as ISO text so both engines hand over the same value type
    return (h.withColumn("date_filter_start", F.col("date_filter_start").cast("string"))
            .withColumn("date_filter_end", F.col("date_filter_end").cast("string")))


def s06(spark, sf_dir, p):
    return driver_page_names(spark, sf_dir).select("source_file", offset_from_name("source_file").alias("offset"))


def s07(spark, sf_dir, p):
    return driver_page_names(spark, sf_dir).select("source_file", file_key("source_file").alias("file_id"))


def s08(spark, sf_dir, p):
    ev = feed.loadable_events(_batch(spark, sf_dir, p).events_all)
    return ev.select("event_id", F.col("event_datetime").alias("event_datetime_raw"),
                     normalise_ts("event_datetime").cast(NTZ).alias("event_datetime"),
                     normalise_ts("event_utc_datetime").cast(NTZ).alias("event_utc_datetime"))


def s09(spark, sf_dir, p):
    return _batch(spark, sf_dir, p).quarantine_events()


def s10(spark, sf_dir, p):
    ev = _batch(spark, sf_dir, p).events()
    return _ntz(ev.select("event_id", "title", "category_type", "event_category_name", "event_datetime",
                          "event_datetime_raw", "event_timezone", "event_utc_datetime", "date_display"),
                "event_datetime", "event_utc_datetime")


def s11(spark, sf_dir, p):
    return _batch(spark, sf_dir, p).performers().select("performer_slug", "performer_name")


def s12(spark, sf_dir, p):
    return _batch(spark, sf_dir, p).venues().select("venue_slug", "venue_name", "city", "state", "country")


def s13(spark, sf_dir, p):
    b = settled(_batch(spark, sf_dir, p), ("performer_slug", "performer", "venue_slug", "venue"))  # both bridges read it
    return (b.event_performers().select(F.lit("performer").alias("bridge"), "event_id",
                                        F.col("performer_slug").alias("slug"))
            .unionByName(b.event_venues().select(F.lit("venue").alias("bridge"), "event_id",
                                                 F.col("venue_slug").alias("slug"))))


def s14(spark, sf_dir, p):
    return _ntz(_batch(spark, sf_dir, p).market().drop("run_id", "loaded_at"), "stats_last_updated_at")


def s15(spark, sf_dir, p):
    return _batch(spark, sf_dir, p).windows().drop("run_id")


def s16(spark, sf_dir, p):
    """The archive with its payloads' digests, and beside each what the tables rebuilt from the archive say of its event."""
    archive = written(_batch(spark, sf_dir, p).raw_archive(keep_ord=True), "raw-archive")
    again = replay_batch(archive)
    said = again.market().select(F.col("event_id").alias("again_id"), F.col("get_in_price").alias("replayed_price")).join(
        again.events().select(F.col("event_id").alias("again_id"), F.col("title").alias("replayed_title")), "again_id")
    payload = read_payload(F.col("raw_json"))
    rows = archive.select("raw_id", "source_file", "source_offset", "event_id", F.sha2("raw_json", 256).alias("payload_sha256"),
                          payload["title"].alias("payload_title"), payload["stats_total_quantity_of_tickets"].alias("payload_quantity"))
    return rows.join(said, rows.event_id == said.again_id, "left").drop("again_id")


# ---- W keys ------------------------------------------------------------------------------------

def _delivery(ev: DataFrame, p: Params, later: bool, every: bool = False) -> DataFrame:
    ts = as_of_lit(p) + (F.expr("INTERVAL 1 DAY") if later else F.expr("INTERVAL 0 DAY"))
    k = F.col("event_id")
    if later:
        ev = (ev.where(k % 2 == 0).withColumn("title", F.concat("title", F.lit(" v2")))
              .withColumn("event_datetime", F.col("event_datetime") + F.expr("INTERVAL 1 DAY")))
    elif not every:
        ev = ev.where((k % 3 != 0) | (k % 2 != 0))  # the later one has all even keys: together they cover the table
    o = merge.ordinal(ts, F.concat(F.lit("orders__offset-"), (k - k % 100).cast("string"), F.lit(".json")), k % 100)
    return (ev.withColumn("first_seen_at", ts).withColumn("last_seen_at", ts)
            .withColumn(merge.FIRST_ORD, o).withColumn(merge.LAST_ORD, o))


W_EVENT_COLS = ["event_id", "title", "event_datetime", "first_seen_at", "last_seen_at"]


def w01(spark, sf_dir, p):
    ev = events_view(spark, sf_dir, p)
    t = merge.upsert(None, _delivery(ev, p, False), merge.EVENT_RULES)
    return merge.upsert(t, _delivery(ev, p, True), merge.EVENT_RULES).select(*W_EVENT_COLS)


def _deliveries(entities: DataFrame, number, p: Params, rules: merge.MergeRules, changed: str) -> DataFrame:
    """Two deliveries of ``entities`` merged: the first without some of those that the later one brings with ``changed`` altered."""
    def delivery(later: bool) -> DataFrame:
        ts = as_of_lit(p) + (F.expr("INTERVAL 1 DAY") if later else F.expr("INTERVAL 0 DAY"))
        d = entities.where(number % 2 == 0) if later else entities.where((number % 3 != 0) | (number % 2 != 0))
        if later:
            d = d.withColumn(changed, F.concat(changed, F.lit(" v2")))
        o = merge.ordinal(ts, F.lit("delivery"), number)
        d = d.withColumns({"loaded_at": ts, "run_id": F.lit("run-b" if later else "run-a")} if rules.last_seen is None
                          else {"first_seen_at": ts, "last_seen_at": ts})
        return d.withColumn(merge.FIRST_ORD, o).withColumn(merge.LAST_ORD, o)

    return merge.upsert(merge.upsert(None, delivery(False), rules), delivery(True), rules)


def w02(spark, sf_dir, p):
    """Performers, venues and feed files: the first delivery's values stay, the last one's time (of a file, its run too) is taken."""
    out = []
    for kind, rows, rules, name in (("performer", performers_view(spark, sf_dir, p), merge.PERFORMER_RULES, "performer_name"),
                                    ("venue", venues_view(spark, sf_dir, p), merge.VENUE_RULES, "venue_name")):
        key = rules.key[0]
        got = _deliveries(rows, F.element_at(F.split(F.col(key), "-"), -1).cast("bigint"), p, rules, name)
        out.append(got.select(F.lit(kind).alias("kind"), F.col(key).alias("entity"), F.col(name).alias("value"), F.lit(None).cast("string").alias("run_id"),
                              "first_seen_at", "last_seen_at"))
    files = _deliveries(pages_view(spark, sf_dir, p), F.expr("`offset` div 100"), p, merge.FILE_RULES_REFERENCE, "feed_status")
    out.append(files.select(F.lit("feed_file").alias("kind"), F.col("file_id").alias("entity"), F.col("feed_status").alias("value"), "run_id",
                            F.lit(None).cast(NTZ).alias("first_seen_at"), F.col("loaded_at").alias("last_seen_at")))
    return out[0].unionByName(out[1]).unionByName(out[2])


LI_KEY = ["l_orderkey", "l_linenumber"]
LI_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


def w03(spark, sf_dir, p):
    li = read_table(spark, sf_dir, "lineitem")
    order = F.struct(*[F.col(c) for c in LI_ORDER])
    target = (li.where(F.col("l_orderkey") % 3 == 0).groupBy(*LI_KEY)
              .agg(F.max_by(F.struct(*LI_COLS), order).alias("_r")).select(*LI_KEY, "_r.*"))
    batch = li.select(*LI_KEY, *LI_COLS, order.alias("_o"))
    new = merge.insert_if_absent(target, batch, LI_KEY, "_o").drop("_o")
    return target.unionByName(new)


def w04(spark, sf_dir, p):
    ev = events_view(spark, sf_dir, p)
    a = _delivery(ev, p, False, every=True)
    return merge.upsert(merge.upsert(None, a, merge.EVENT_RULES), a, merge.EVENT_RULES).select(*W_EVENT_COLS)


class _Fails(RuntimeError):
    pass


def _failing_once(store: TableStore, table: str, batch: int) -> TableStore:
    """``store``, whose write of ``table`` fails the first time that batch number comes."""
    write, state = store.append_delta, {"left": 1}

    def append_delta(name, df, tag, *a, **kw):
        if name == table and tag.endswith(f"-b{batch}") and state["left"]:
            state["left"] = 0
            raise _Fails(f"{table} of {tag}")
        write(name, df, tag, *a, **kw)

    store.append_delta = append_delta
    return store


def w05(spark, sf_dir, p):
    """A load that ends in the middle of its second batch and is called again: its events, and how often their page was loaded."""
    path = _write_pages(spark, sf_dir, p, "stream-in")
    base, checkpoint = shared_scratch(spark, "stream-store"), shared_scratch(spark, "stream-ckpt")
    args = (checkpoint, DRIVER_RUN_ID)
    try:
        incremental_load(spark, path, _failing_once(TableStore(spark, base), "market", 1), *args, started_at=p.as_of)
    except StreamingQueryException as e:
        if "_Fails" not in str(e):
            raise
    store = TableStore(spark, base)
    incremental_load(spark, path, store, *args, started_at=p.as_of)
    t = pipeline.load_tables(store)
    times = pipeline.read_table(store, "page_log").where("valid").groupBy("source_file").agg(F.count(F.lit(1)).alias("times_loaded"))
    return (t.events.join(t.raw_events.select("event_id", "source_file"), "event_id").join(times, "source_file")
            .select("event_id", "title", "category_type", "event_category_name", "times_loaded"))


def w06(spark, sf_dir, p):
    m = market_view(spark, sf_dir, p)
    k = F.col("event_id")
    a = m.where((k % 3 != 0) | (k % 2 != 0)).withColumn("run_id", F.lit("run-a"))
    b = (m.where(k % 2 == 0).withColumn("run_id", F.lit("run-b"))
         .withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 1 DAY")))
    snaps = a.unionByName(b)
    return merge.latest_snapshot(snaps).select("event_id", "run_id", "get_in_price", "loaded_at")


def w07(spark, sf_dir, p):
    store = TableStore(spark, shared_scratch(spark, "ledger-store"))
    metrics = pipeline.write_page_log(settled(_batch(spark, sf_dir, p)), store, DRIVER_RUN_ID, DRIVER_RUN_ID)
    return pipeline.ledger_from_metrics(spark.createDataFrame([metrics], pipeline.METRICS), F.lit(DRIVER_RUN_ID), as_of_lit(p), as_of_lit(p), "driver") \
        .select("run_id", "files_found", "files_loaded", "events_loaded", "status")


def w08(spark, sf_dir, p):
    ev = read_table(spark, sf_dir, "events")
    day = F.to_date("ts")
    runs = ev.groupBy(day.alias("d")).agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"))
    run_id = F.concat(F.lit("run-"), F.col("d").cast("string"))
    status = F.when(F.dayofyear("d") % 7 == 3, F.lit("failed")).otherwise(F.lit("success"))
    start = runs.select(run_id.alias("run_id"), "started_at", F.lit(None).cast(NTZ).alias("finished_at"),
                        F.lit("running").alias("status"))
    done = runs.select(run_id.alias("run_id"), "started_at", "finished_at", status.alias("status"))
    return ledger.latest_successful_run(start.unionByName(done))


def w09(spark, sf_dir, p):
    b = settled(_batch(spark, sf_dir, p))  # both quarantines read it
    reasons = written(ledger.ingest_dq_reasons(b.quarantine_files(), b.quarantine_events()), "ingest-reasons")  # both outputs read it
    cols = ["check_name", "severity", "status", "affected_count", "source_file", "event_id", "reason"]
    none = {c: F.lit(None).cast("string") for c in cols}
    rows = ledger.ingest_dq_rows(reasons, F.lit(DRIVER_RUN_ID), as_of_lit(p))
    rows = rows.withColumns({c: none[c] for c in ("source_file", "event_id", "reason")}).select(*cols)
    return rows.unionByName(reasons.withColumns({"severity": none["severity"], "status": none["status"],
                                                 "affected_count": F.lit(None).cast("bigint")}).select(*cols))


def w10(spark, sf_dir, p):
    """All result sets, written: rows, digest and error of each."""
    t = driver_tables(spark, sf_dir, p)
    t = t.with_(**{name: written(getattr(t, name), name) for name in t.names()})  # each is read by many checks and reports
    t = t.with_(market_events=written(market_events(t, p), "market-events"))  # and these are joined for a dozen reports
    dq = written(dq_suite(t, p), "dq")  # a row a check; the report and the KPIs read it
    done = sink_result_sets(pipeline.report_builders(t, dq, p), shared_scratch(spark, "results"))
    return spark.createDataFrame([(name, w.rows, w.digest, w.error) for name, w in done.items()],
                                 "result_set string, rows bigint, digest string, error string")


FNS = {
    "feed_scan_pages": s01, "feed_quarantine_files": s02, "feed_validate_pages": s03,
    "feed_explode_events": s04, "feed_page_header": s05, "feed_offset_from_name": s06, "feed_file_key": s07,
    "feed_normalise_ts": s08, "feed_quarantine_events": s09, "build_events": s10, "build_performers": s11,
    "build_venues": s12, "build_bridges": s13, "build_market_state": s14, "unpivot_windows": s15,
    "build_raw_archive": s16,
    "upsert_partial_columns": w01, "upsert_touch_last_seen": w02, "insert_if_absent": w03,
    "idempotent_reload": w04, "stream_incremental_load": w05, "latest_snapshot": w06, "run_ledger": w07,
    "latest_successful_run": w08, "dq_ingest_malformed": w09, "sink_result_sets": w10,
}


def _run(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return fn(spark, sf_dir, Params())


def queries():
    return {k: partial(_run, fn) for k, fn in FNS.items()}


# ---- oracles -----------------------------------------------------------------------------------
JSON_VIEWS = {
    "v_jpages": """
  SELECT page_offset, page_offset // 100 AS pg, 'orders__offset-' || CAST(page_offset AS VARCHAR) || '.json' AS source_file
  FROM v_pages_agg WHERE (page_offset // 100) % 37 <> 36""",
    "v_jstate": """
  SELECT *, pg % 40 = 39 AS corrupt,
         CASE WHEN pg % 40 = 39 THEN 'JSON parse error'
              ELSE NULLIF(concat_ws('; ', CASE WHEN pg % 25 = 24 THEN 'status != success (got ''error'')' END,
                                          CASE WHEN pg % 30 = 29 THEN 'missing data.events' END), '') END AS reason
  FROM v_jpages""",
    "v_jev": """
  SELECT o.o_orderkey AS k, s.source_file, s.page_offset,
         CAST(ROW_NUMBER() OVER (PARTITION BY s.page_offset ORDER BY o.o_orderkey) - 1 AS INTEGER) AS pos,
         CASE WHEN o.o_orderkey % 1999 = 11 THEN NULL ELSE o.o_orderkey END AS id,
         o.o_custkey, o.o_orderdate, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN v_jstate s ON o.o_orderkey - o.o_orderkey % 100 = s.page_offset
  WHERE s.reason IS NULL""",
    "v_jload": """
  SELECT * FROM v_jev WHERE id IS NOT NULL AND id <> 0""",
    "v_jtext": lambda: _event_text_sql(),
    "v_jpagetext": lambda: _page_text_sql(),
}
ISO_SQL = "strftime({x}, '%Y-%m-%dT%H:%M:%SZ')"
SHIFTED = "CASE WHEN j.k % 251 = 0 THEN j.o_orderdate + INTERVAL 2 DAY ELSE j.o_orderdate END"

S_SQL = {
    "feed_scan_pages": "SELECT source_file, CAST(length(value) AS BIGINT) AS n_chars, sha256(value) AS text_sha256 FROM v_jpagetext",
    "feed_quarantine_files": "SELECT source_file, reason FROM v_jstate WHERE reason IS NOT NULL",
    "feed_validate_pages": """
SELECT source_file, CASE WHEN pg % 25 = 24 THEN 'error' ELSE 'success' END AS status,
       reason IS NULL AS valid, reason FROM v_jstate WHERE NOT corrupt""",
    "feed_explode_events": "SELECT source_file, pos, id AS event_id FROM v_jev",
    "feed_page_header": f"""
SELECT substr(sha256(s.source_file), 1, 16) AS file_id, 'driver-run' AS run_id, s.source_file,
       CAST(s.page_offset AS BIGINT) AS "offset", 'success' AS feed_status, t.total AS total_db_matches,
       a.n AS current_page_results, a.page_offset < t.last_offset AS has_more, 100 AS limit_per_page,
       CAST(NULL AS VARCHAR) AS tab_requested, CAST(t.dmin AS VARCHAR) AS date_filter_start,
       CAST(t.dmax AS VARCHAR) AS date_filter_end,
       a.upcoming AS upcoming_count, a.n - a.upcoming AS past_count, CAST(a.n AS BIGINT) AS total_count,
       {AS_OF} AS loaded_at
FROM v_jstate s JOIN v_pages_agg a USING (page_offset) CROSS JOIN v_pages_tot t WHERE s.reason IS NULL""",
    "feed_offset_from_name": 'SELECT source_file, CAST(page_offset AS BIGINT) AS "offset" FROM v_jpages',
    "feed_file_key": "SELECT source_file, substr(sha256(source_file), 1, 16) AS file_id FROM v_jpages",
    "feed_normalise_ts": f"""
SELECT j.k AS event_id,
       CASE WHEN j.k % 401 = 3 THEN 'not-a-date' ELSE {ISO_SQL.format(x=SHIFTED)} END AS event_datetime_raw,
       CASE WHEN j.k % 401 = 3 THEN NULL ELSE {SHIFTED} END AS event_datetime,
       CASE WHEN j.k % 1201 = 5 THEN NULL ELSE j.o_orderdate END AS event_utc_datetime
FROM v_jload j""",
    "feed_quarantine_events": """
SELECT source_file, 'missing id' AS reason, COALESCE(CAST(id AS VARCHAR), '') AS event_id
FROM v_jev WHERE id IS NULL OR id = 0""",
    "build_events": f"""
SELECT e.event_id, e.title, e.category_type, e.event_category_name, e.event_datetime,
       CASE WHEN j.k % 401 = 3 THEN 'not-a-date' ELSE {ISO_SQL.format(x=SHIFTED)} END AS event_datetime_raw,
       e.event_timezone, e.event_utc_datetime, e.date_display
FROM v_jload j JOIN v_events e ON e.event_id = j.k""",
    "build_performers": """
SELECT 'performer-' || CAST(j.o_custkey AS VARCHAR) AS performer_slug, MIN(c.c_name) AS performer_name
FROM v_jload j JOIN customer c ON c.c_custkey = j.o_custkey WHERE j.k % 700 <> 0 GROUP BY 1""",
    "build_venues": """
SELECT DISTINCT 'venue-n' || CAST(n.n_nationkey AS VARCHAR) AS venue_slug, n.n_name || ' Hall' AS venue_name,
       n.n_name AS city, CAST(NULL AS VARCHAR) AS state, r.r_name AS country
FROM v_jload j JOIN nation n ON n.n_nationkey = j.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "build_bridges": """
SELECT DISTINCT 'performer' AS bridge, k AS event_id, 'performer-' || CAST(o_custkey AS VARCHAR) AS slug
FROM v_jload WHERE k % 700 <> 0
UNION ALL
SELECT DISTINCT 'venue' AS bridge, k AS event_id, 'venue-n' || CAST(c_nationkey AS VARCHAR) AS slug FROM v_jload""",
    "build_market_state": """
SELECT m.state_id, m.event_id, m.source_file, m.get_in_price, m.stats_total_quantity, m.stats_last_updated_at,
       m.forecast_is_available, m.forecast_value, m.forecast_layover_text, m.forecast_hover_text,
       m.is_past_with_no_pricing, m.mock_data_point, m.disable_click_through
FROM v_jload j JOIN v_market m ON m.event_id = j.k""",
    "unpivot_windows": """
SELECT w.window_id, w.event_id, w.window_days, w.direction, w.percent_change, w.raw_change, w.insufficient_data
FROM v_jload j JOIN v_windows w ON w.event_id = j.k
WHERE NOT (w.window_days = 3 AND j.k % 13 = 5) AND NOT (w.window_days = 30 AND j.k % 13 = 4)""",
    "build_raw_archive": """
SELECT substr(sha256(j.source_file), 1, 16) || ':' || CAST(j.k AS VARCHAR) AS raw_id, j.source_file,
       CAST(j.page_offset AS BIGINT) AS source_offset, j.k AS event_id, sha256(t.text) AS payload_sha256, e.title AS payload_title,
       CAST(m.stats_total_quantity AS BIGINT) AS payload_quantity, m.get_in_price AS replayed_price, e.title AS replayed_title
FROM v_jload j JOIN v_jtext t USING (k) JOIN v_events e ON e.event_id = j.k JOIN v_market m ON m.event_id = j.k""",
}

W_DELIV = f"""
  a AS (SELECT event_id, title, event_datetime, {AS_OF} AS seen FROM v_events WHERE event_id % 3 <> 0 OR event_id % 2 <> 0),
  b AS (SELECT event_id, title || ' v2' AS title, event_datetime + INTERVAL 1 DAY AS event_datetime,
               {AS_OF} + INTERVAL 1 DAY AS seen FROM v_events WHERE event_id % 2 = 0)"""
W_LI_ORDER = ", ".join(["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                        "l_tax", "l_returnflag", "l_linestatus"])
W_LI_ORDER_DESC = ", ".join(c + " DESC" for c in W_LI_ORDER.split(", "))

W_SQL = {
    "upsert_partial_columns": f"""
SELECT COALESCE(a.event_id, b.event_id) AS event_id,
       CASE WHEN b.event_id IS NOT NULL THEN b.title ELSE a.title END AS title,
       CASE WHEN a.event_id IS NOT NULL THEN a.event_datetime ELSE b.event_datetime END AS event_datetime,
       CASE WHEN a.event_id IS NOT NULL THEN a.seen ELSE b.seen END AS first_seen_at,
       CASE WHEN b.event_id IS NOT NULL THEN b.seen ELSE a.seen END AS last_seen_at
FROM a FULL OUTER JOIN b ON a.event_id = b.event_id""",
    "upsert_touch_last_seen": "\nUNION ALL\n".join(f"""
SELECT '{kind}' AS kind, COALESCE(a.entity, b.entity) AS entity, COALESCE(a.value, b.value || ' v2') AS value,
       {"CASE WHEN b.entity IS NOT NULL THEN 'run-b' ELSE 'run-a' END" if kind == 'feed_file' else 'NULL'} AS run_id,
       {'CAST(NULL AS TIMESTAMP)' if kind == 'feed_file' else f'CASE WHEN a.entity IS NULL THEN {AS_OF} + INTERVAL 1 DAY ELSE {AS_OF} END'} AS first_seen_at,
       CASE WHEN b.entity IS NOT NULL THEN {AS_OF} + INTERVAL 1 DAY ELSE {AS_OF} END AS last_seen_at
FROM (SELECT {key} AS entity, {value} AS value FROM {view} WHERE {number} % 6 <> 0) a
FULL OUTER JOIN (SELECT {key} AS entity, {value} AS value FROM {view} WHERE {number} % 2 = 0) b ON a.entity = b.entity"""
        for kind, view, key, value, number in (
            ("performer", "v_performers", "performer_slug", "performer_name", "CAST(split_part(performer_slug, '-', 2) AS BIGINT)"),
            ("venue", "v_venues", "venue_slug", "venue_name", "CAST(split_part(venue_slug, '-', 2) AS BIGINT)"),
            ("feed_file", "v_pages", "file_id", "feed_status", '("offset" // 100)'))),
    "insert_if_absent": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {W_LI_ORDER}) AS rf,
            ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {W_LI_ORDER_DESC}) AS rl
  FROM lineitem) x
WHERE (l_orderkey % 3 = 0 AND rl = 1) OR (l_orderkey % 3 <> 0 AND rf = 1)""",
    "idempotent_reload": f"""
SELECT event_id, title, event_datetime, {AS_OF} AS first_seen_at, {AS_OF} AS last_seen_at
FROM v_events""",
    "stream_incremental_load": """
SELECT e.event_id, e.title, e.category_type, e.event_category_name, 1 AS times_loaded FROM v_jload j JOIN v_events e ON e.event_id = j.k""",
    "latest_snapshot": f"""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'run-b' ELSE 'run-a' END AS run_id, get_in_price,
       CASE WHEN event_id % 2 = 0 THEN loaded_at + INTERVAL 1 DAY ELSE loaded_at END AS loaded_at
FROM v_market""",
    "run_ledger": """
SELECT 'driver-run' AS run_id, (SELECT COUNT(*) FROM v_jpages) AS files_found,
       (SELECT COUNT(*) FROM v_jstate WHERE reason IS NULL) AS files_loaded,
       (SELECT COUNT(*) FROM v_jload) AS events_loaded, 'success' AS status""",
    "latest_successful_run": """
SELECT arg_max(run_id, finished_at) AS run_id, MAX(finished_at) AS finished_at FROM (
  SELECT 'run-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, MAX(ts) AS finished_at,
         CASE WHEN dayofyear(CAST(ts AS DATE)) % 7 = 3 THEN 'failed' ELSE 'success' END AS status
  FROM events GROUP BY CAST(ts AS DATE)) r WHERE status = 'success'""",
    "dq_ingest_malformed": """
SELECT check_name, 'ERROR' AS severity, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n AS affected_count,
       NULL AS source_file, NULL AS event_id, NULL AS reason
FROM (SELECT 'malformed_files' AS check_name, COUNT(*) AS n FROM qf UNION ALL SELECT 'malformed_events', COUNT(*) FROM qe) x
UNION ALL SELECT 'malformed_files', NULL, NULL, NULL, source_file, NULL, reason FROM qf
UNION ALL SELECT 'malformed_events', NULL, NULL, NULL, source_file, event_id, reason FROM qe""",
}
W_SQL_PREFIX = {
    "upsert_partial_columns": W_DELIV,
    "dq_ingest_malformed": """
  qf AS (SELECT source_file, reason FROM v_jstate WHERE reason IS NOT NULL),
  qe AS (SELECT source_file, COALESCE(CAST(id AS VARCHAR), '') AS event_id, 'missing id' AS reason
         FROM v_jev WHERE id IS NULL OR id = 0)""",
}


def _json_fields(fields: dict[str, tuple[str, str]]) -> str:
    """A JSON object of the fields (name -> (kind, SQL)) that are not null, in order."""
    shown = {"text": """'"' || {x} || '"'""", "number": "CAST({x} AS VARCHAR)", "json": "{x}"}
    return "'{' || concat_ws(',', " + ", ".join(
        f"""'"{name}":' || {shown[kind].format(x=f"({x})")}""" for name, (kind, x) in fields.items()) + ") || '}'"


def _event_text_sql() -> str:
    """k, text: every order's event as the JSON its page holds."""
    shifted = "CASE WHEN o.o_orderkey % 251 = 0 THEN o.o_orderdate + INTERVAL 2 DAY ELSE o.o_orderdate END"
    # + 0.0: no page holds a negative zero
    moved = _json_fields({"direction": ("text", "direction"), "percent": ("number", "percent_change + 0.0"), "raw": ("number", "raw_change + 0.0"),
                          "insufficient_data": ("number", "insufficient_data")})
    fields = {
        "id": ("number", "CASE WHEN o.o_orderkey % 1999 <> 11 THEN o.o_orderkey END"), "title": ("text", "c.c_name"),
        "performer": ("text", "CASE WHEN o.o_orderkey % 700 <> 0 THEN c.c_name END"),
        "performer_slug": ("text", "'performer-' || o.o_custkey"), "venue": ("text", "n.n_name || ' Hall'"),
        "venue_slug": ("text", "'venue-n' || c.c_nationkey"), "city": ("text", "n.n_name"), "country": ("text", "r.r_name"),
        "date": ("text", "CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR)"),
        "event_datetime": ("text", f"CASE WHEN o.o_orderkey % 401 = 3 THEN 'not-a-date' ELSE {ISO_SQL.format(x=shifted)} END"),
        "event_timezone": ("text", "'UTC'"),
        "event_utc_datetime": ("text", f"CASE WHEN o.o_orderkey % 1201 <> 5 THEN {ISO_SQL.format(x='o.o_orderdate')} END"),
        "category_type": ("text", "c.c_mktsegment"), "event_category_name": ("text", "o.o_orderpriority"),
        "get_in_price": ("number", "m.get_in_price"), "stats_total_quantity_of_tickets": ("number", "m.stats_total_quantity"),
        "stats_last_updated_at": ("text", ISO_SQL.format(x="m.stats_last_updated_at")),
        "forecast_is_available": ("number", "m.forecast_is_available"), "forecast_value": ("number", "CAST(m.forecast_value AS DOUBLE)"),
        "forecast_layover_text": ("text", "m.forecast_layover_text"), "forecast_hover_text": ("text", "m.forecast_hover_text"),
        "is_past_with_no_pricing": ("number", "m.is_past_with_no_pricing"), "mock_data_point": ("number", "m.mock_data_point"),
        "disable_click_through": ("number", "m.disable_click_through"),
        "3day_price_change": ("json", "CASE WHEN o.o_orderkey % 13 <> 5 THEN w3 END"), "7day_price_change": ("json", "w7"),
        "14day_price_change": ("json", "w14"), "30day_price_change": ("json", "CASE WHEN o.o_orderkey % 13 = 4 THEN '{}' ELSE w30 END"),
    }
    wide = ", ".join(f"any_value({moved}) FILTER (WHERE window_days = {d}) AS w{d}" for d in (3, 7, 14, 30))
    return f"""
  SELECT o.o_orderkey AS k, {_json_fields(fields)} AS text
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN v_market m ON m.event_id = o.o_orderkey
  LEFT JOIN (SELECT event_id, {wide} FROM v_windows GROUP BY event_id) w ON w.event_id = o.o_orderkey"""


def _page_text_sql() -> str:
    """source_file, value: every page as the text of its file."""
    iso = ISO_SQL.format(x=AS_OF)
    meta = _json_fields({
        "categorization": ("json", _json_fields({"current_utc": ("text", iso), "total_count": ("number", "a.n"), "upcoming_count": ("number", "a.upcoming"),
                                                 "past_count": ("number", "a.n - a.upcoming")})),
        "filters": ("json", _json_fields({"date_range": ("json", _json_fields({"start_date": ("text", "t.dmin"), "end_date": ("text", "t.dmax"),
                                                                               "is_any": ("number", "false")}))})),
        "pagination": ("json", _json_fields({"offset": ("number", "s.page_offset"), "limit": ("number", "100"), "current_page_results": ("number", "a.n"),
                                             "has_more": ("number", "s.page_offset < t.last_offset"), "total_database_matches": ("number", "t.total")})),
        "performance_timing": ("json", "'{\"total_seconds\":1.0}'")})
    return f"""
  SELECT source_file, CASE WHEN corrupt THEN substr(whole, 1, length(whole) // 2) ELSE whole END || chr(10) AS value FROM (
    SELECT s.source_file, s.corrupt, '{{"status":"' || CASE WHEN s.pg % 25 = 24 THEN 'error' ELSE 'success' END || '","data":{{"metadata":' || {meta} ||
      CASE WHEN s.pg % 30 = 29 THEN '' WHEN s.pg % 2 = 1 THEN ',"events":' || e.events ELSE ',"events":{{"all":' || e.events || ',"past":[],"upcoming":[]}}' END
      || '}}}}' AS whole
    FROM v_jstate s JOIN v_pages_agg a USING (page_offset)
    JOIN (SELECT k - k % 100 AS page_offset, '[' || string_agg(text, ',' ORDER BY k) || ']' AS events FROM v_jtext GROUP BY 1) e USING (page_offset)
    CROSS JOIN v_pages_tot t) x"""


JSON_VIEWS = {k: v() if callable(v) else v for k, v in JSON_VIEWS.items()}


RESULT_SETS = {
    "01_events_by_category": "events_by_category", "02_events_by_geography": "events_by_geography", "03_top20_by_get_in_price": "top20_by_price",
    "04_top20_by_ticket_quantity": "top20_by_quantity", "05_top20_3day_price_movement": "top20_move_3d", "06_top20_7day_price_movement": "top20_move_7d",
    "07_zero_price_events": "zero_price_events", "08_stale_stats": "stale_stats", "09_forecast_available_events": "forecast_available",
    "10_forecast_coverage_by_category": "forecast_coverage", "11_median_price_by_category": "median_price_by_category",
    "12_median_price_by_city_venue": "median_price_by_venue", "13_suspicious_price_changes": "suspicious_changes",
    "14_event_counts_by_source_file": "counts_by_source_file",
}


def _sink_sql() -> str:
    """Rows and order-free digest of every result set."""
    sets = {name: REPORTS[key] for name, key in RESULT_SETS.items()}
    sets["15_dq_failure_counts"] = detailed_suite_sql()
    sets["pricing_review_ranked"] = SCORING["pricing_review"]
    fails = f"SELECT COUNT(*) FILTER (WHERE status = 'FAIL' AND severity IN ('ERROR', 'WARNING')) AS dq_fails FROM ({suite_sql()}) s"
    sets["kpis"] = "SELECT * FROM " + " CROSS JOIN ".join(f"({sql}) k{n}" for n, sql in enumerate([*KPIS.values(), fails]))
    text = ("COALESCE(CASE WHEN typeof(COLUMNS(*)) = 'DOUBLE' THEN CAST(TRY_CAST(COLUMNS(*) AS DECIMAL(38,6)) AS VARCHAR) "
            "ELSE CAST(COLUMNS(*) AS VARCHAR) END, 'NULL')")
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS result_set, COUNT(*) AS rows, CAST(COALESCE(SUM(CAST('0x' || substr(md5(t), 1, 12) AS BIGINT)), 0) AS VARCHAR) AS digest,
  CAST(NULL AS VARCHAR) AS error FROM (SELECT concat_ws('|', *COLUMNS(*)) AS t FROM (SELECT {text} FROM ({sql}) q) r) x""" for name, sql in sets.items())


def _with_prefix(key: str, body: str) -> str:
    return with_views(body, JSON_VIEWS, W_SQL_PREFIX.get(key, ""))


def oracle_sql():
    out = {k: with_views(v, JSON_VIEWS) for k, v in S_SQL.items()}
    out.update({k: _with_prefix(k, v) for k, v in W_SQL.items()})
    out["sink_result_sets"] = with_views(_sink_sql(), SCORE_VIEWS)
    return out
