"""Role views: the feed tables played by the driver's TPC-H-like tables.

The driver tables hold no ticket data, so each feed table is a deterministic
view over them (k = o_orderkey). Modular predicates on k inject the defects
the data-quality suite looks for (a NULL price, an unparseable date, a dropped
page ...). They never shrink the work: every view reads its whole tables, and
each view grows linearly with them.

The same definitions exist as DuckDB SQL in ``feedlens.plans.oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.config import WINDOW_DAYS, Params
from feedlens.functions.columns import as_of_lit, file_key, round_half_away
from feedlens.operators.common import join_small_side
from feedlens.tables import FeedTables

DRIVER_RUN_ID = "driver-run"
PAGE_SIZE = 100

# Fixed seeds for the injected defects (moduli on o_orderkey or page number).
SEEDS = {
    "datetime_shift_2d": (251, 0),     # event_datetime two days after UTC time
    "datetime_unparseable": (401, 3),  # raw datetime text 'not-a-date'
    "utc_missing": (1201, 5),          # UTC datetime text absent
    "price_null": (997, 0),
    "price_zero": (6, 0),
    "quantity_negative": (499, 0),
    "forecast_available": (3, 0),
    "mock_point": (1000, 7),
    "no_performer": (700, 0),
    "window_forced_flat": (211, 0),
    "insufficient_raw_one": (20, 0),
    "page_dropped": (37, 36),
    "page_error": (50, 49),
    "page_no_total": (60, 59),
    "raw_dropped": (1301, 0),
    "raw_id_null": (1999, 11),
}


def _hit(col, name):
    m, r = SEEDS[name]
    return (col % F.lit(m)) == F.lit(r)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source_file(offset_col):
    return F.concat(F.lit("orders__offset-"), offset_col.cast("string"), F.lit(".json"))


def _offset(k):
    return k - (k % F.lit(PAGE_SIZE))


def events_view(spark, sf_dir, p: Params) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("o_orderkey")
    dt_raw = F.when(_hit(k, "datetime_unparseable"), F.lit("not-a-date")).otherwise(F.col("o_orderdate").cast("string"))
    utc_raw = F.when(_hit(k, "utc_missing"), F.lit(None).cast("string")).otherwise(F.col("o_orderdate").cast("string"))
    parsed = F.col("event_datetime_raw").try_cast("timestamp_ntz")
    as_of = as_of_lit(p)
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .select(
            k.alias("event_id"),
            F.col("c_name").alias("title"),
            F.col("c_mktsegment").alias("category_type"),
            F.col("o_orderpriority").alias("event_category_name"),
            dt_raw.alias("event_datetime_raw"),
            utc_raw.alias("event_utc_raw"),
            F.to_date("o_orderdate").cast("string").alias("date_display"),
        )
        .select(
            "event_id", "title", "category_type", "event_category_name",
            F.when(_hit(F.col("event_id"), "datetime_shift_2d"), parsed + F.expr("INTERVAL 2 DAYS"))
             .otherwise(parsed).alias("event_datetime"),
            "event_datetime_raw",
            F.lit("UTC").alias("event_timezone"),
            F.col("event_utc_raw").try_cast("timestamp_ntz").alias("event_utc_datetime"),
            "date_display",
            as_of.alias("first_seen_at"),
            as_of.alias("last_seen_at"),
        )
    )


def _market_fields(k, total, ordered, qty, upd, as_of) -> list:
    """Price, quantity, forecast and flags of order ``k``; ``qty`` and ``upd``: its lines' summed quantity and last ship date."""
    price = (F.when(_hit(k, "price_null"), F.lit(None).cast("double"))
             .when(_hit(k, "price_zero"), F.lit(0.0))
             .otherwise(total))
    fval = (F.when(k % 10 == 1, F.lit(-100.0))
            .when(k % 10 == 2, F.lit(-1.0))
            .otherwise((k % 100).cast("double") / F.lit(100.0)))
    return [
        price.alias("get_in_price"),
        F.when(_hit(k, "quantity_negative"), F.lit(-1))
         .otherwise(qty.cast("int")).alias("stats_total_quantity"),
        upd.alias("stats_last_updated_at"),
        _hit(k, "forecast_available").alias("forecast_is_available"),
        fval.alias("forecast_value"),
        F.when(fval >= 0.5, F.lit("Prices likely to rise"))
         .otherwise(F.lit("Prices likely to fall")).alias("forecast_layover_text"),
        F.concat((k % 100).cast("string"), F.lit("% confidence")).alias("forecast_hover_text"),
        ((price == F.lit(0.0)) & (ordered < as_of)).alias("is_past_with_no_pricing"),
        F.when(_hit(k, "mock_point"), F.lit(1)).otherwise(F.lit(0)).alias("mock_data_point"),
        F.lit(0).alias("disable_click_through"),
    ]


def _lined_orders(spark, sf_dir) -> DataFrame:
    """Per order: price, date and its lines' summed quantity and last ship date."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    li = (read_table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum("l_quantity").alias("qty"), F.max("l_shipdate").alias("upd")))
    return o.join(li, o.o_orderkey == li.l_orderkey, "left")


def market_view(spark, sf_dir, p: Params) -> DataFrame:
    k = F.col("o_orderkey")
    as_of = as_of_lit(p)
    return (
        _lined_orders(spark, sf_dir)
        .select(
            F.concat(F.lit(DRIVER_RUN_ID + ":"), k.cast("string")).alias("state_id"),
            F.lit(DRIVER_RUN_ID).alias("run_id"),
            k.alias("event_id"),
            _source_file(_offset(k)).alias("source_file"),
            *_market_fields(k, F.col("o_totalprice"), F.col("o_orderdate"), F.col("qty"), F.col("upd"), as_of),
            as_of.alias("loaded_at"),
        )
    )


def event_venues_view(spark, sf_dir) -> DataFrame:
    return (read_table(spark, sf_dir, "lineitem")
            .select(F.col("l_orderkey").alias("event_id"),
                    F.concat(F.lit("venue-"), F.col("l_suppkey").cast("string")).alias("venue_slug"))
            .distinct())


def venues_view(spark, sf_dir, p: Params) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    as_of = as_of_lit(p)
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.concat(F.lit("venue-"), F.col("s_suppkey").cast("string")).alias("venue_slug"),
                    F.col("s_name").alias("venue_name"),
                    F.col("n_name").alias("city"),
                    F.lit(None).cast("string").alias("state"),
                    F.col("r_name").alias("country"),
                    as_of.alias("first_seen_at"), as_of.alias("last_seen_at")))


def performers_view(spark, sf_dir, p: Params) -> DataFrame:
    as_of = as_of_lit(p)
    return (read_table(spark, sf_dir, "customer")
            .select(F.concat(F.lit("performer-"), F.col("c_custkey").cast("string")).alias("performer_slug"),
                    F.col("c_name").alias("performer_name"),
                    as_of.alias("first_seen_at"), as_of.alias("last_seen_at")))


def event_performers_view(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return (o.where(~_hit(F.col("o_orderkey"), "no_performer"))
            .select(F.col("o_orderkey").alias("event_id"),
                    F.concat(F.lit("performer-"), F.col("o_custkey").cast("string")).alias("performer_slug")))


def _cents(total):
    return F.round(total * F.lit(100.0), 0).cast("bigint")


def _day(ordered):
    return F.unix_date(F.to_date(ordered))


def _priced_orders(spark, sf_dir) -> DataFrame:
    """Per order: its category, price in cents and day."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("event_id"),
                    F.col("c_mktsegment").alias("category_type"),
                    _cents(F.col("o_totalprice")).alias("cents"),
                    _day(F.col("o_orderdate")).alias("day")))


def _trailing_prices(base: DataFrame) -> DataFrame:
    """Per category and day the trailing category average p_d for every d.

    p_d(day) = average price (in cents) of the category's orders on the d days
    before ``day``. The frame excludes the current day, so every order of one
    (category, day) shares p_d: compute it on the (category, day) aggregate,
    which is bounded by categories x days, and join it back. No window ever
    runs over raw rows, so a hot category cannot pile up in one task."""
    daily = base.groupBy("category_type", "day").agg(F.sum("cents").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("category_type").orderBy("day")
    return daily.select(
        "category_type", "day",
        *[(F.sum("s").over(w.rangeBetween(-d, -1)).cast("double")
           / F.sum("n").over(w.rangeBetween(-d, -1)).cast("double")).alias(f"p{d}") for d in WINDOW_DAYS])


def _window_base(spark, sf_dir) -> DataFrame:
    """Per order: cents and the trailing category average p_d for every d."""
    base = _priced_orders(spark, sf_dir)
    return base.join(_trailing_prices(base), ["category_type", "day"])


def _window_fields(k, cents, avg) -> list:
    """direction, percent_change, raw_change, insufficient_data of one window."""
    diff = cents.cast("double") - avg
    no_p = avg.isNull()
    return [
        F.when(_hit(k, "window_forced_flat"), F.lit("flat"))
         .when(diff > 0, F.lit("up")).when(diff < 0, F.lit("down")).otherwise(F.lit("flat")),
        F.when(no_p, F.lit(0.0)).otherwise(round_half_away(F.lit(100.0) * diff / F.nullif(avg, F.lit(0.0)), 2)),
        F.when(no_p, F.when(_hit(k, "insufficient_raw_one"), F.lit(1.0)).otherwise(F.lit(0.0)))
         .otherwise(F.round(diff, 0) / F.lit(100.0)),
        no_p,
    ]


WINDOW_FIELD_NAMES = ("direction", "percent_change", "raw_change", "insufficient_data")


def windows_view(spark, sf_dir, p: Params) -> DataFrame:
    """Long format: one row per (event, window days)."""
    b = _window_base(spark, sf_dir)
    k = F.col("event_id")
    per = F.explode(F.array(*[
        F.struct(F.lit(d).cast("int").alias("window_days"),
                 *[c.alias(n) for c, n in zip(_window_fields(k, F.col("cents"), F.col(f"p{d}")), WINDOW_FIELD_NAMES)])
        for d in WINDOW_DAYS])).alias("w")
    return b.select("event_id", per).select(
        F.concat_ws(":", F.lit(DRIVER_RUN_ID), k.cast("string"), F.col("w.window_days").cast("string")).alias("window_id"),
        F.lit(DRIVER_RUN_ID).alias("run_id"), "event_id", "w.*")


def pages_view(spark, sf_dir, p: Params) -> DataFrame:
    """Page headers (raw_feed_files role): one page per 100 order keys."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    as_of = as_of_lit(p)
    k = F.col("o_orderkey")
    pages = (o.groupBy((k - k % PAGE_SIZE).alias("offset"))
             .agg(F.count(F.lit(1)).cast("int").alias("n"),
                  F.count_if(F.col("o_orderdate") >= as_of).alias("upcoming")))
    totals = o.agg(F.count(F.lit(1)).alias("total"), F.max(k - k % PAGE_SIZE).alias("last_offset"),
                   F.to_date(F.min("o_orderdate")).alias("dmin"), F.to_date(F.max("o_orderdate")).alias("dmax"))
    page = F.expr(f"`offset` div {PAGE_SIZE}")
    src = _source_file(F.col("offset"))
    return (
        pages.where(~_hit(page, "page_dropped"))
        .crossJoin(F.broadcast(totals))  # exactly one row
        .select(
            file_key(src).alias("file_id"),
            F.lit(DRIVER_RUN_ID).alias("run_id"),
            src.alias("source_file"),
            F.col("offset").cast("bigint").alias("offset"),
            F.when(_hit(page, "page_error"), F.lit("error")).otherwise(F.lit("success")).alias("feed_status"),
            F.when(_hit(page, "page_no_total"), F.lit(None).cast("bigint"))
             .otherwise(F.col("total")).alias("total_db_matches"),
            F.col("n").alias("current_page_results"),
            (F.col("offset") < F.col("last_offset")).alias("has_more"),
            F.lit(PAGE_SIZE).alias("limit_per_page"),
            F.lit(None).cast("string").alias("tab_requested"),
            F.col("dmin").alias("date_filter_start"),
            F.col("dmax").alias("date_filter_end"),
            F.col("upcoming").alias("upcoming_count"),
            (F.col("n") - F.col("upcoming")).alias("past_count"),
            F.col("n").cast("bigint").alias("total_count"),
            as_of.alias("loaded_at"),
        )
    )


def raw_view(spark, sf_dir, p: Params) -> DataFrame:
    """Raw event archive role: orders minus dropped ones, a few ids lost."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    src = _source_file(_offset(k))
    eid = F.when(_hit(k, "raw_id_null"), F.lit(None).cast("bigint")).otherwise(k)
    return (o.where(~_hit(k, "raw_dropped"))
            .select(F.concat_ws(":", file_key(src), eid.cast("string")).alias("raw_id"),
                    F.lit(DRIVER_RUN_ID).alias("run_id"),
                    src.alias("source_file"),
                    _offset(k).alias("source_offset"),
                    eid.alias("event_id"),
                    as_of_lit(p).alias("loaded_at")))


def driver_tables(spark: SparkSession, sf_dir: str, p: Params | None = None) -> FeedTables:
    p = p or Params()
    return FeedTables(
        feed_files=pages_view(spark, sf_dir, p),
        raw_events=raw_view(spark, sf_dir, p),
        events=events_view(spark, sf_dir, p),
        performers=performers_view(spark, sf_dir, p),
        venues=venues_view(spark, sf_dir, p),
        event_performers=event_performers_view(spark, sf_dir),
        event_venues=event_venues_view(spark, sf_dir),
        market=market_view(spark, sf_dir, p),
        windows=windows_view(spark, sf_dir, p),
    )


# ---------------------------------------------------------------------------
# Feed pages built from the role views (for the page-parsing operators)
# ---------------------------------------------------------------------------
PAGE_SEEDS = {
    "page_truncated": (40, 39),      # text cut in half -> JSON parse error
    "page_status_error": (25, 24),   # status 'error'
    "page_no_events": (30, 29),      # data without 'events'
    "window30_empty": (13, 4),       # 30day_price_change written as {}
    "window3_absent": (13, 5),       # 3day_price_change missing
}
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _page_hit(col, name):
    m, r = PAGE_SEEDS[name]
    return (col % F.lit(m)) == F.lit(r)


def _iso(col):
    return F.date_format(col, ISO)


def _on_page(page_offset):
    return ~_hit(F.expr(f"{page_offset} div {PAGE_SIZE}"), "page_dropped")


def driver_page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of ``driver_pages``, (source_file), without their texts: neither lines nor windows decide on a page."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(_offset(F.col("o_orderkey")).alias("page_offset")).distinct().where(_on_page("page_offset"))
            .select(_source_file(F.col("page_offset")).alias("source_file")))


def _page_events(spark, sf_dir, p: Params) -> DataFrame:
    """(page_offset, k, order, customer and nation columns, market fields, w3 .. w30) per event, rows of one page in one task.

    Orders, market and windows meet on the order key as the narrow columns that their fields are made of; the joined
    rows go to their page's task so, and fields and texts are made there. Texts are not shuffled."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    m = _lined_orders(spark, sf_dir).select(F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("total"),
                                            F.col("o_orderdate").alias("ordered"), "qty", "upd")
    base = _priced_orders(spark, sf_dir)
    averages = [f"p{d}" for d in WINDOW_DAYS]
    w = join_small_side(base, _trailing_prices(base), ["category_type", "day"]).select(F.col("event_id").alias("moved_id"), "cents", *averages)
    joined = (o.drop("o_totalprice").join(c, o.o_custkey == c.c_custkey)
              # both on the order key: rows joined once stay where they are for the second join
              .join(m, o.o_orderkey == m.event_id, "left").join(w, o.o_orderkey == w.moved_id, "left"))
    placed = (joined.select(_offset(F.col("o_orderkey")).alias("page_offset"), F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate", "o_orderpriority",
                            "c_name", "c_mktsegment", "c_nationkey", "total", "ordered", "qty", "upd", "moved_id", "cents", *averages)
              .where(_on_page("page_offset")).repartition("page_offset"))
    placed = placed.join(n, placed.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("k")
    names = ("direction", "percent", "raw", "insufficient_data")
    # one lambda for all windows: four copies of it would make the row's generated method too long for the JVM to compile
    per = F.transform(F.array(*averages), lambda avg: F.struct(*[x.alias(f) for x, f in zip(_window_fields(k, F.col("cents"), avg), names)]))
    return placed.select(
        "page_offset", "k", "o_custkey", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment", "c_nationkey", "n_name", "r_name",
        *_market_fields(k, F.col("total"), F.col("ordered"), F.col("qty"), F.col("upd"), as_of_lit(p)),
        F.when(F.col("moved_id").isNotNull(), per).alias("ws")).select(
        "*", *[F.col("ws")[i].alias(f"w{d}") for i, d in enumerate(WINDOW_DAYS)])


def driver_pages(spark: SparkSession, sf_dir: str, p: Params | None = None) -> DataFrame:
    """Feed pages as (source_file, value): one JSON document per 100 orders.

    Each page groups at most 100 events (one per order key), so collecting a
    page's events is a bounded group. Odd pages carry the bare-list form of
    ``events``, even pages the {all, past, upcoming} object."""
    p = p or Params()
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ok, k = F.col("o_orderkey"), F.col("k")
    empty = F.struct(*[F.lit(None).cast(t).alias(f) for f, t in
                       (("direction", "string"), ("percent", "double"), ("raw", "double"),
                        ("insufficient_data", "boolean"))])
    shifted = F.when(_hit(k, "datetime_shift_2d"), F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")) \
        .otherwise(F.col("o_orderdate"))
    event = F.struct(
        F.when(_hit(k, "raw_id_null"), F.lit(None).cast("bigint")).otherwise(k).alias("id"),
        F.col("c_name").alias("title"),
        F.when(_hit(k, "no_performer"), F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("performer"),
        F.concat(F.lit("performer-"), F.col("o_custkey").cast("string")).alias("performer_slug"),
        F.concat(F.col("n_name"), F.lit(" Hall")).alias("venue"),
        F.concat(F.lit("venue-n"), F.col("c_nationkey").cast("string")).alias("venue_slug"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.when(_hit(k, "datetime_unparseable"), F.lit("not-a-date")).otherwise(_iso(shifted)).alias("event_datetime"),
        F.lit("UTC").alias("event_timezone"),
        F.when(_hit(k, "utc_missing"), F.lit(None).cast("string")).otherwise(_iso(F.col("o_orderdate")))
         .alias("event_utc_datetime"),
        F.col("c_mktsegment").alias("category_type"),
        F.col("o_orderpriority").alias("event_category_name"),
        "get_in_price",
        F.col("stats_total_quantity").alias("stats_total_quantity_of_tickets"),
        _iso(F.col("stats_last_updated_at")).alias("stats_last_updated_at"),
        "forecast_is_available", "forecast_value", "forecast_layover_text", "forecast_hover_text",
        "is_past_with_no_pricing", "mock_data_point", "disable_click_through",
        F.when(_page_hit(k, "window3_absent"), F.lit(None)).otherwise(F.col("w3")).alias("3day_price_change"),
        F.col("w7").alias("7day_price_change"),
        F.col("w14").alias("14day_price_change"),
        F.when(_page_hit(k, "window30_empty"), empty).otherwise(F.col("w30")).alias("30day_price_change"),
    )
    rows = _page_events(spark, sf_dir, p).select("page_offset", "k", F.to_json(event).alias("text"),
                                                 (F.col("o_orderdate") >= as_of_lit(p)).alias("upcoming"))
    totals = o.agg(F.count(F.lit(1)).alias("total"), F.max(_offset(ok)).alias("last_offset"),
                   F.to_date(F.min("o_orderdate")).cast("string").alias("dmin"),
                   F.to_date(F.max("o_orderdate")).cast("string").alias("dmax"))
    pages = (rows.groupBy("page_offset")
             .agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("evs"),
                  F.count(F.lit(1)).cast("int").alias("n"), F.count_if("upcoming").alias("up"))
             .crossJoin(F.broadcast(totals)))  # exactly one row
    page = F.expr(f"page_offset div {PAGE_SIZE}")
    meta = F.to_json(F.struct(
        F.struct(_iso(as_of_lit(p)).alias("current_utc"), F.col("n").cast("bigint").alias("total_count"),
                 F.col("up").alias("upcoming_count"), (F.col("n") - F.col("up")).alias("past_count"))
         .alias("categorization"),
        F.struct(F.struct(F.col("dmin").alias("start_date"), F.col("dmax").alias("end_date"),
                          F.lit(False).alias("is_any")).alias("date_range")).alias("filters"),
        F.struct(F.col("page_offset").alias("offset"), F.lit(PAGE_SIZE).alias("limit"),
                 F.col("n").alias("current_page_results"),
                 (F.col("page_offset") < F.col("last_offset")).alias("has_more"),
                 F.col("total").alias("total_database_matches")).alias("pagination"),
        F.struct(F.lit(1.0).alias("total_seconds")).alias("performance_timing")))
    arr = F.concat(F.lit("["), F.array_join(F.transform("evs", lambda x: x["text"]), ","), F.lit("]"))
    events = F.when(page % 2 == 1, arr).otherwise(
        F.concat(F.lit('{"all":'), arr, F.lit(',"past":[],"upcoming":[]}')))
    events_part = F.when(_page_hit(page, "page_no_events"), F.lit("")).otherwise(
        F.concat(F.lit(',"events":'), events))
    status = F.when(_page_hit(page, "page_status_error"), F.lit("error")).otherwise(F.lit("success"))
    text = (F.when(_page_hit(page, "page_truncated"), F.expr("substr(_t, 1, length(_t) div 2)"))
            .otherwise(F.col("_t")))
    return (pages.where(_on_page("page_offset"))
            .withColumn("_t", F.concat(F.lit('{"status":"'), status, F.lit('","data":{"metadata":'), meta,
                                       events_part, F.lit("}}")))
            .select(_source_file(F.col("page_offset")).alias("source_file"), text.alias("value")))
