"""Pages are parsed once and written by the executors."""

import os

import pytest
from pyspark.sql import functions as F

from feed_pages import make_event, make_feed_file, page_name, pages_frame
from feedlens.config import Params
from feedlens.operators import merge
from feedlens.operators.ingest import build_batch, settled
from feedlens.plans import feed_queries
from feedlens.sources import driver, feed
from feedlens.tables import FeedTables

PAGES = [(page_name(0), make_feed_file([make_event({"id": 1}), make_event({"id": None})])), (page_name(100), "{cut")]


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_a_filter_does_not_parse_texts_again(spark):
    b = build_batch(pages_frame(spark, PAGES), "r", F.lit("2026-05-27"))
    events = {"events": b.events(), "venues": b.venues(), "market": b.market(), "quarantine": b.quarantine_events()}
    assert {k: _parses(df) for k, df in events.items()} == dict.fromkeys(events, 4)  # page, events as object, as list, event
    assert _parses(b.windows()) == 4 + len(feed.WINDOW_FIELDS)
    assert (_parses(b.headers), _parses(b.quarantine_files())) == (2, 1)
    assert [r["event_id"] for r in b.events().collect()] == [1]
    assert [(r["source_file"], r["reason"]) for r in b.quarantine_files().collect()] == [(page_name(100), "JSON parse error")]


def test_page_files_are_written_under_their_names_without_a_rename_by_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "shared_scratch", lambda *a: (_ for _ in ()).throw(AssertionError("parts for the driver to rename")))
    names = ["007", "a b+c%.json", "é.json", "x=1.json"]
    pages = spark.createDataFrame([(n, f"{{{n}\n") for n in names] + [("none.json", None), ("x=1.json", "{x=1.json\n")], "source_file string, value string")
    folder = str(tmp_path / "in folder")
    feed.write_page_files(pages, folder)
    assert sorted(os.listdir(folder)) == sorted([*names, "none.json"])
    got = {r["source_file"]: r["value"] for r in feed.scan_pages(spark, folder, "*").collect()}
    assert got == {"007": "{007\n\n", "a b+c%.json": "{a b+c%.json\n\n", "é.json": "{é.json\n\n", "x=1.json": "{x=1.json\n\n" * 2, "none.json": "\n"}


def test_a_batchs_tables_are_written_side_by_side(spark, tmp_path):
    import threading

    from feedlens.plans import pipeline
    from feedlens.sources.store import TableStore

    store, both = TableStore(spark, str(tmp_path / "store")), threading.Barrier(2, timeout=60)
    write = store.append_delta

    def append_delta(name, *a, **kw):
        if name in ("events", "market"):
            both.wait()  # neither goes on before the other has begun
        if name == "windows":
            raise KeyError("windows failed")
        write(name, *a, **kw)

    store.append_delta = append_delta
    with pytest.raises(KeyError, match="windows failed"):
        pipeline.ingest_pages(spark, pages_frame(spark, PAGES), store, "r1")
    assert not os.path.exists(store.delta_root("batch_metrics"))  # a batch that failed midway has no numbers
    store.append_delta = write
    pipeline.ingest_pages(spark, pages_frame(spark, PAGES), store, "r1")
    assert pipeline.read_table(store, "windows").count() == 4
    assert [tuple(r)[1:] for r in pipeline.batch_metrics(store, "r1").collect()] == [(2, 1, 1)]


def test_result_sets_read_tables_written_once(spark, monkeypatch):
    rows, seen = spark.range(3).toDF("event_id"), {}
    monkeypatch.setattr(feed_queries, "driver_tables", lambda *a: FeedTables(*[rows] * 9))
    monkeypatch.setattr(feed_queries, "dq_suite", lambda *a: rows)
    monkeypatch.setattr(feed_queries.pipeline, "report_builders", lambda t, dq, p: seen.update(t=t) or {"one": lambda: t.market})
    done = feed_queries.w10(spark, "none", Params()).collect()
    assert [(r["result_set"], r["rows"], r["error"]) for r in done] == [("one", 3, None)]
    assert all(getattr(seen["t"], name).inputFiles() for name in seen["t"].names())


def test_events_are_joined_to_market_and_windows_without_a_second_shuffle(spark, tmp_path):
    tables = {"orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
              "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string", "nation": "n_nationkey int, n_name string, n_regionkey int",
              "region": "r_regionkey int, r_name string", "lineitem": "l_orderkey bigint, l_quantity double, l_shipdate timestamp_ntz"}
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = driver.driver_pages(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("(")[1].split(" = ")[0] for line in plan.splitlines() if "Join LeftOuter" in line and "l_orderkey" not in line]
    assert len(keys) == 2 and keys[0] == keys[1] and keys[0].startswith("o_orderkey"), keys


PAGE_TABLES = {"orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
               "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string", "nation": "n_nationkey int, n_name string, n_regionkey int",
               "region": "r_regionkey int, r_name string", "lineitem": "l_orderkey bigint, l_quantity double, l_shipdate timestamp_ntz"}


def _page_tables(spark, folder, **rows) -> str:
    for name, schema in PAGE_TABLES.items():
        spark.createDataFrame(rows.get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_event_texts_are_made_in_their_pages_task_and_not_shuffled(spark, tmp_path):
    plan = driver.driver_pages(spark, _page_tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = {line.find(mark): i for i, line in enumerate(plan) for mark in ("Repartition",) if mark in line}
    made = [i for i, line in enumerate(plan) if "StructsToJson" in line and "insufficient_data" in line]
    assert len(at) == 1 and made and max(made) < min(at.values())  # above the shuffle on the page
    assert "page_offset" in plan[min(at.values())]
    executed = driver.driver_pages(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("Exchange hashpartitioning(page_offset" in line for line in executed) == 1


def test_pages_of_repeated_and_null_keys_hold_every_joined_row(spark, tmp_path):
    import json
    from datetime import datetime

    days = [datetime(2001, 1, d) for d in (1, 2, 3)]
    folder = _page_tables(
        spark, tmp_path, nation=[(1, "N", 1)], region=[(1, "R")],
        customer=[(1, "c1", 1, "A"), (1, "c1b", 1, None), (2, "c2", 9, "A"), (3, None, 1, "A")],
        # key 1 twice: customer 1 (two rows, one without a category) and customer 2 (no nation); key 2: no customer; key 3 lacks a price
        orders=[(1, 1, 1.0, days[0], "p"), (1, 2, 2.0, days[1], "p"), (2, 8, 3.0, days[1], "p"), (3, 3, None, days[2], None), (None, 1, 5.0, days[0], "p"),
                (3600, 1, 6.0, days[0], "p")],  # on the dropped page
        lineitem=[(1, 2.0, days[0]), (1, 3.0, days[2]), (None, 1.0, days[0])])
    pages = {r["source_file"]: r["value"] for r in driver.driver_pages(spark, folder).collect()}
    assert list(pages) == ["orders__offset-0.json"] == [r["source_file"] for r in driver.driver_page_names(spark, folder).collect()]
    events = json.loads(pages["orders__offset-0.json"])["data"]["events"]["all"]
    one = [(e["title"], e["get_in_price"], e["7day_price_change"]["raw"]) for e in events if e["id"] == 1]
    # 2 rows with a nation x 2 market rows x 2 windows; the second is of day 2, after 4.0 on average
    assert sorted(one) == sorted((t, m, w) for t in ("c1", "c1b") for m in (1.0, 2.0) for w in (0.0, -2.0))
    assert {e["stats_total_quantity_of_tickets"] for e in events if e["id"] == 1} == {5}
    assert [(e["id"], "get_in_price" in e, "title" in e, e["7day_price_change"]["direction"]) for e in events if e["id"] != 1] == [(3, False, False, "flat")]
    assert len(events) == 9


def test_a_keys_buffer_holds_two_ordinals(spark):
    b = build_batch(pages_frame(spark, PAGES), "r", F.lit("2026-05-27"))
    plan = b.events()._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("min_by("), plan.count("max_by(")) == (1, 1)
    rows = [("a", "x", None, 1, 1), ("a", None, "z", 2, 2), ("b", "y", "w", None, None)]
    rules = merge.MergeRules(key=("k",), first=("f",), latest=("l",), first_seen=None, last_seen=None)
    df = spark.createDataFrame(rows, f"k string, f string, l string, {merge.FIRST_ORD} int, {merge.LAST_ORD} int")
    got = merge.combine(df, rules)
    assert got.columns == ["k", "l", "f", merge.FIRST_ORD, merge.LAST_ORD]
    assert sorted(map(tuple, got.collect())) == [("a", "z", "x", 1, 2), ("b", None, None, None, None)]


def test_a_settled_batch_is_parsed_once_and_says_the_same(spark):
    cut, none, listed = page_name(100), make_feed_file(offset=200), make_feed_file()
    listed["data"]["events"] = [make_event({"id": 5}), None, make_event({"id": 0}), make_event({"id": 5, "venue": ""})]
    pages = [*PAGES, (page_name(200), none), (page_name(300), listed), (page_name(300), listed), (page_name(400), make_feed_file(status="error"))]
    b = build_batch(pages_frame(spark, pages), "r", F.lit("2026-05-27"))
    s = settled(b, ("performer_slug", "performer", "venue_slug", "venue"))
    for out in (lambda x: x.pages.select("source_file", "is_corrupt", "status", "reason", "valid"), lambda x: x.quarantine_files(),
                lambda x: x.quarantine_events(), lambda x: x.event_performers(), lambda x: x.event_venues(),
                lambda x: x.events_all.select("source_file", "pos", "id", "bad_reason"), lambda x: x.loaded.select("event_id", "_ord"),
                lambda x: feed_queries.pipeline.page_log(x, "r")):
        assert _parses(out(s)) == 0
        assert sorted(map(str, out(s).collect())) == sorted(map(str, out(b).collect()))
    assert cut in {r["source_file"] for r in s.quarantine_files().collect()}


def test_queries_of_two_outputs_settle_their_batch(spark, monkeypatch):
    monkeypatch.setattr(feed_queries, "_batch", lambda *a: build_batch(pages_frame(spark, PAGES), "r", F.lit("2026-05-27")))
    assert _parses(feed_queries.s13(spark, "none", Params())) == 0
    made = []
    monkeypatch.setattr(feed_queries, "settled", lambda *a: made.append(settled(*a)) or made[-1])
    assert feed_queries.w09(spark, "none", Params()).count() == 4
    assert [tuple(r) for r in feed_queries.w07(spark, "none", Params()).collect()] == [(feed_queries.DRIVER_RUN_ID, 2, 1, 1, "success")]
    assert len(made) == 2
