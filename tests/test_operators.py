"""Properties of the scale-oriented operators: each must equal the plain
(single-task) formulation it replaces."""

import random
from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlens.operators import merge
from feedlens.operators.common import top_then_expand
from feedlens.operators.quality import next_offsets
from feedlens.operators.stats import median_by


def test_median_matches_percentile_on_skewed_groups(spark):
    rng = random.Random(7)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 1000), (None, 5), ("hot", 20000)):
        for i in range(n):
            v = rng.choice([rng.random() * 100, round(rng.random() * 10, 2), 3.0])
            rows.append((g, 1e9 if (g == "hot" and i == 0) else v))
    df = spark.createDataFrame(rows, "g string, v double")
    expected = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    for buckets, small in ((1 << 16, 1 << 20), (1 << 16, 0), (4, 0), (2, 3)):
        got = {r["g"]: r["median"] for r in
               median_by(df, ["g"], "v", buckets=buckets, small_group_distinct=small).collect()}
        assert got == expected, (buckets, small)


def test_two_level_lead_equals_global_lead(spark):
    rng = random.Random(3)
    rows = []
    for feed in ("x", "y"):
        offs = sorted(rng.sample(range(0, 5000, 100), 30)) + [700, 700]
        for i, o in enumerate(offs):
            rows.append((date(2026, 5, 27), date(2026, 6, 26), None if feed == "x" else feed, o, 100, f"{feed}-{i}"))
    df = spark.createDataFrame(rows, "date_filter_start date, date_filter_end date, tab_requested string, "
                                     "offset long, limit_per_page int, source_file string")
    w = Window.partitionBy("date_filter_start", "date_filter_end", "tab_requested") \
        .orderBy("offset", "limit_per_page", "source_file")
    expected = sorted((r["source_file"], r["n"]) for r in
                      df.select("source_file", F.lead("offset").over(w).alias("n")).collect())
    for bucket in (1 << 20, 500, 100):
        got = sorted((r["source_file"], r["next_offset"]) for r in next_offsets(df, bucket).collect())
        assert got == expected, bucket


def test_top_then_expand_equals_join_sort_limit(spark):
    rng = random.Random(5)
    ranked = spark.createDataFrame([(i, float(rng.randint(0, 20))) for i in range(200)], "event_id long, score double")
    bridge = spark.createDataFrame([(rng.randint(0, 199), f"v{rng.randint(0, 9)}") for _ in range(300)],
                                   "event_id long, venue string").distinct()
    order = [F.col("score").desc(), F.col("event_id").asc()]
    full = ranked.join(bridge, "event_id").orderBy(*order, "venue").limit(20).collect()
    got = (top_then_expand(ranked, order, 20, bridge).select("event_id", "score", "venue")
           .orderBy(*order, "venue").limit(20).collect())
    assert [tuple(r) for r in got] == [tuple(r) for r in full]


def _batch(spark, rows, ts):
    df = spark.createDataFrame(rows, "event_id long, title string, event_datetime timestamp, src string, pos int")
    o = merge.ordinal(F.lit(ts).cast("timestamp"), F.col("src"), F.col("pos"))
    for c in ("event_datetime_raw", "event_timezone", "event_utc_datetime", "date_display",
              "category_type", "event_category_name"):
        df = df.withColumn(c, F.lit(None).cast("timestamp" if c == "event_utc_datetime" else "string"))
    return (df.withColumn("first_seen_at", F.lit(ts).cast("timestamp"))
            .withColumn("last_seen_at", F.lit(ts).cast("timestamp"))
            .withColumn(merge.FIRST_ORD, o).withColumn(merge.LAST_ORD, o).drop("src", "pos"))


def test_upsert_is_independent_of_arrival_order(spark):
    d1, d2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    a = _batch(spark, [(1, "a1", d1, "p-0.json", 0), (2, "a2", d1, "p-0.json", 1)], d1)
    b = _batch(spark, [(1, "b1", d2, "p-100.json", 0), (3, "b3", d2, "p-100.json", 1)], d2)
    cols = ["event_id", "title", "event_datetime", "first_seen_at", "last_seen_at"]
    ab = merge.upsert(merge.upsert(None, a, merge.EVENT_RULES), b, merge.EVENT_RULES).select(*cols)
    ba = merge.upsert(merge.upsert(None, b, merge.EVENT_RULES), a, merge.EVENT_RULES).select(*cols)
    bounded = merge.upsert(merge.upsert(None, a, merge.EVENT_RULES), b, merge.EVENT_RULES,
                           small_batch=True).select(*cols)
    exp = {1: ("b1", d1, d1, d2), 2: ("a2", d1, d1, d1), 3: ("b3", d2, d2, d2)}
    for df in (ab, ba, bounded):
        got = {r["event_id"]: (r["title"], r["event_datetime"], r["first_seen_at"], r["last_seen_at"])
               for r in df.collect()}
        assert got == exp


def test_insert_if_absent_replay_appends_nothing(spark):
    batch = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 0)], "k long, v string, o int")
    first = merge.insert_if_absent(None, batch, ["k"], "o")
    assert sorted((r["k"], r["v"]) for r in first.collect()) == [(1, "y"), (2, "z")]
    again = merge.insert_if_absent(first, batch, ["k"], "o")
    assert again.count() == 0


def test_join_small_side_same_result_with_and_without_broadcast(spark):
    from feedlens.operators.common import join_small_side
    big = spark.createDataFrame([(i % 5, i) for i in range(100)], "k int, v int")
    small = spark.createDataFrame([(k, k * 10) for k in range(4)], "k int, w int")
    a = sorted(tuple(r) for r in join_small_side(big, small, "k", "left", max_rows=10).collect())
    b = sorted(tuple(r) for r in join_small_side(big, small, "k", "left", max_rows=0).collect())
    assert a == b and len(a) == 100


def test_median_modes_agree_where_exact(spark):
    from feedlens.operators.reports import grouped_price_stats
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)] + [("b", 5.0)], "g string, get_in_price double")
    meds = {}
    for mode in ("distributed", "percentile", "approx"):
        meds[mode] = {r["g"]: r["_median"] for r in grouped_price_stats(df, ["g"], median=mode).collect()}
    assert meds["distributed"] == meds["percentile"] == {"a": 2.5, "b": 5.0}
    assert meds["approx"]["b"] == 5.0 and meds["approx"]["a"] in (2.0, 3.0)


def test_top_then_expand_looks_up_its_first_rows_alone_and_all_only_if_these_are_too_few(spark):
    order = [F.col("score").desc_nulls_last(), F.col("event_id").asc_nulls_last()]
    ranked = spark.range(200).select(F.col("id").alias("event_id"), (F.lit(1000.0) - F.col("id")).alias("score"))
    ranked = ranked.unionByName(spark.createDataFrame([(None, 5000.0), (7, None)], "event_id long, score double"))

    def got(bridge, n=3):
        df = top_then_expand(ranked, order, n, bridge)
        want = ranked.join(bridge, "event_id").orderBy(*order, "venue").limit(n)
        rows = sorted(map(tuple, df.select("event_id", "score", "venue").orderBy(*order, "venue").limit(n).collect()))
        assert rows == sorted(map(tuple, want.select("event_id", "score", "venue").collect()))
        return df._jdf.queryExecution().optimizedPlan().toString(), len(rows)

    early = spark.createDataFrame([(2, "a"), (2, "b"), (5, "a"), (9, "c"), (None, "x"), (150, "z")], "event_id long, venue string")
    plan, n = got(early)
    assert n == 3 and "Range" not in plan  # the ranked rows are not read again
    plan, n = got(early.where("event_id = 150 OR event_id = 9"))  # 9 is among the first 30 rows and 150 is not
    assert n == 2 and "Range" in plan
    assert got(early.limit(0))[1] == 0


def test_reports_read_market_and_events_joined_once(spark, monkeypatch):
    from feedlens.config import Params
    from feedlens.plans import feed_queries
    from feedlens.tables import FeedTables

    market = spark.createDataFrame([("r", 1, 5.0), ("r", 1, 6.0), ("r", 2, 7.0), ("r", None, 8.0), ("r", 9, 9.0)], "run_id string, event_id long, get_in_price double")
    events = spark.createDataFrame([(1, "one"), (2, "two"), (2, "two again"), (None, "none")], "event_id long, title string")
    seen = {}
    monkeypatch.setattr(feed_queries, "driver_tables", lambda *a: FeedTables(*[events] * 7, market, events))
    monkeypatch.setattr(feed_queries, "dq_suite", lambda *a: events)
    monkeypatch.setattr(feed_queries.pipeline, "report_builders", lambda t, dq, p: seen.update(t=t) or {"one": lambda: t.market})
    feed_queries.w10(spark, "none", Params()).collect()
    joined = feed_queries.market_events(seen["t"], Params())
    assert joined.inputFiles() and "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["event_id"], r["get_in_price"], r["title"]) for r in joined.collect()) == [
        (1, 5.0, "one"), (1, 6.0, "one"), (2, 7.0, "two"), (2, 7.0, "two again")]
