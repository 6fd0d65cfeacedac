"""Incremental (streaming) load and the end-to-end batch pipeline."""

import os
from datetime import datetime

from feed_pages import make_event, make_feed_file, page_name, write_page
from feedlens.config import Params
from feedlens.plans import pipeline
from feedlens.sources import feed
from feedlens.sources.store import TableStore
from feedlens.streaming.incremental import incremental_load


def test_stream_loads_each_file_once(spark, tmp_path):
    inp = tmp_path / "in"
    inp.mkdir()
    for offset, eid in [(0, 111), (100, 222), (200, 333)]:
        write_page(inp, page_name(offset), make_feed_file([make_event({"id": eid})], offset=offset))
    write_page(inp, page_name(300), "{not valid json{{")
    store = TableStore(spark, str(tmp_path / "store"))
    ckpt = str(tmp_path / "ckpt")
    led = incremental_load(spark, str(inp), store, ckpt, "run-1", datetime(2026, 5, 27), max_files=2).first()
    assert (led["files_found"], led["files_loaded"], led["events_loaded"]) == (4, 3, 3)
    t = pipeline.load_tables(store)
    assert t.events.count() == 3 and t.market.count() == 3 and t.windows.count() == 12
    # a second run over the same checkpoint sees no new file
    led2 = incremental_load(spark, str(inp), store, ckpt, "run-2", datetime(2026, 5, 28), max_files=2).first()
    assert (led2["files_found"], led2["events_loaded"]) == (0, 0)
    assert pipeline.load_tables(store).events.count() == 3


def test_batch_pipeline_checks_and_outputs(spark, tmp_path):
    inp = tmp_path / "in"
    inp.mkdir()
    events = [make_event({"id": 1}), make_event({"id": 2, "get_in_price": 0}),
              make_event({"id": 3, "forecast_is_available": True, "forecast_value": -1})]
    write_page(inp, page_name(0), make_feed_file(events))
    store = TableStore(spark, str(tmp_path / "store"))
    pipeline.run_batch(spark, feed.scan_pages(spark, str(inp)), store, "run-1", str(inp), datetime(2026, 5, 27))
    t = pipeline.load_tables(store)
    p = Params(as_of=datetime(2026, 5, 30), ntz=False, run_id="run-1")
    dq = pipeline.record_checks(spark, t, store, "run-1", p)
    res = {r["check_name"]: (r["status"], r["affected_count"]) for r in dq.collect()}
    assert res["get_in_price_zero_flagged"] == ("FAIL", 1)
    assert res["forecast_sentinel_not_treated_as_prediction"] == ("FAIL", 1)
    assert res["stats_last_updated_stale"] == ("FAIL", 3)
    assert res["event_id_unique_in_events_table"] == ("PASS", 0)
    out = str(tmp_path / "out")
    status = pipeline.write_outputs(t, dq, p, out)
    assert all(v == "ok" for v in status.values()), status
    assert os.path.isdir(os.path.join(out, "pricing_review_ranked"))
    review = spark.read.option("header", True).csv(os.path.join(out, "pricing_review_ranked"))
    assert review.count() == 2  # price > 0 only


def test_merge_on_read_equals_compacted_and_survives_replay(spark, tmp_path):
    from feed_pages import pages_frame
    store = TableStore(spark, str(tmp_path / "store"))
    d1 = [(page_name(0), make_feed_file([make_event({"id": 1, "title": "old"}), make_event({"id": 2})]))]
    d2 = [(page_name(100), make_feed_file([make_event({"id": 1, "title": "new"}), make_event({"id": 3})]))]
    pipeline.ingest_pages(spark, pages_frame(spark, d1), store, "run-1", datetime(2026, 5, 27), tag="b1")
    pipeline.ingest_pages(spark, pages_frame(spark, d2), store, "run-1", datetime(2026, 5, 27), tag="b2")
    pipeline.ingest_pages(spark, pages_frame(spark, d2), store, "run-1", datetime(2026, 5, 27), tag="b2")  # replay

    def snapshot():
        t = pipeline.load_tables(store)
        return (sorted((r["event_id"], r["title"]) for r in t.events.collect()),
                t.market.count(), t.windows.count(), t.raw_events.count(), t.event_venues.count())

    before = snapshot()
    assert before == ([(1, "new"), (2, "Test Event"), (3, "Test Event")], 3, 12, 4, 3)
    pipeline.compact(store)
    assert snapshot() == before
    assert store.read_deltas("events").count() == 0  # folded deltas are skipped


def test_unreadable_log_is_an_error_and_history_is_kept(spark, tmp_path):
    import pytest
    store = TableStore(spark, str(tmp_path / "store"))
    for run, day in (("r1", 27), ("r3", 28)):
        pages = [(page_name(0), make_feed_file([make_event({"id": 1})]))]
        from feed_pages import pages_frame
        pipeline.run_batch(spark, pages_frame(spark, pages), store, run, "", datetime(2026, 5, day), compact_after=False)
        t = pipeline.load_tables(store)
        p = Params(as_of=datetime(2026, 5, 30), ntz=False)
        pipeline.record_checks(spark, t, store, run, p)
    assert t.market.count() == 1 and {r["run_id"] for r in t.market.collect()} == {"r3"}
    history = pipeline.check_history(store).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in history} == {"r1": 22, "r3": 22}
    log = tmp_path / "store" / "_versions"
    log.mkdir()
    (log / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        TableStore(spark, str(tmp_path / "store")).current_path("events")


def test_a_second_run_leaves_the_facts_of_the_first_untouched(spark, tmp_path):
    from feed_pages import pages_frame
    store = TableStore(spark, str(tmp_path / "store"))
    facts = ("market", "windows", "raw_events", "page_log")

    def files():
        return {str(f): f.stat().st_mtime_ns for name in facts
                for f in (tmp_path / "store" / name / "part").rglob("*.parquet")}

    def load(run, day, ids):
        pages = [(page_name(0), make_feed_file([make_event({"id": i}) for i in ids]))]
        pipeline.run_batch(spark, pages_frame(spark, pages), store, run, "", datetime(2026, 5, day))

    load("r1", 27, (1, 2))
    first = files()
    load("r2", 28, (1, 2, 3))
    second = files()
    assert first and first.items() < second.items()
    for opened in (store, TableStore(spark, str(tmp_path / "store"))):
        rows = pipeline.load_tables(opened, run_id=pipeline.ALL_RUNS).market.groupBy("run_id").count().collect()
        assert {r["run_id"]: r["count"] for r in rows} == {"r1": 2, "r2": 3}
        t = pipeline.load_tables(opened)
        assert t.market.count() == 3 and t.windows.count() == 12 and t.events.count() == 3
        assert pipeline.read_table(opened, "page_log").count() == 2


def test_a_streams_frames_are_built_once_and_each_batch_writes_its_own_pages(spark, tmp_path, monkeypatch):
    inp = tmp_path / "in"
    inp.mkdir()
    for n in range(5):
        write_page(inp, page_name(100 * n), make_feed_file([make_event({"id": n + 1}), make_event({"id": None})], offset=100 * n))
    write_page(inp, "cut.json", "{")
    built, parse = [], feed.parse_events
    monkeypatch.setattr(feed, "parse_events", lambda *a: built.append(1) or parse(*a))
    store = TableStore(spark, str(tmp_path / "store"))
    ledger = incremental_load(spark, str(inp), store, str(tmp_path / "ckpt"), "run", datetime(2027, 1, 2), max_files=2).first()
    assert (ledger["files_found"], ledger["files_loaded"], ledger["events_loaded"]) == (6, 5, 5)
    assert len(built) == 1  # three batches

    def delivered(table, column):
        rows = spark.read.parquet(store.delta_root(table)).select("tag", column).collect()
        assert {r["tag"] for r in rows} <= {f"t_run-b{b}" for b in range(3)}
        return sorted(r[column] for r in rows)  # every batch's delta, folded or not

    assert delivered("events", "event_id") == delivered("market", "event_id") == [1, 2, 3, 4, 5]
    names = sorted([*(page_name(100 * n) for n in range(5)), "cut.json"])
    assert delivered("page_log", "source_file") == names and len(delivered("event_quarantine", "reason")) == 5
    assert [tuple(r) for r in spark.read.parquet(store.delta_root("batch_metrics")).groupBy().sum("files_found", "events_loaded").collect()] == [(6, 5)]
    again = TableStore(spark, str(tmp_path / "store"))  # tables are folded at once, but the log has all of them
    assert all(again.read_deltas(t).count() == 0 and again.read(t).count() > 0 for t in ("events", "market", "page_log", "event_venues"))
    assert spark.conf.get("spark.sql.codegen.wholeStage") == "true"  # only the stream's own session does without
