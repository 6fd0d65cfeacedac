"""Flat page folders, the raw archive's replay, interrupted loads, observed ledgers, the digest sink, scores without scales."""

import json
from datetime import datetime

import duckdb
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feed_pages import make_event, make_feed_file, page_name, pages_frame, write_page
from feedlens.config import Params
from feedlens.operators import ingest, scoring, sink
from feedlens.plans import pipeline
from feedlens.plans.oracles import SCORE_VIEWS, SCORING
from feedlens.sources import feed
from feedlens.sources.store import TableStore
from feedlens.streaming.incremental import incremental_load
from feedlens.tables import FeedTables

DAY = datetime(2027, 1, 2)


def test_pages_of_a_flat_folder(spark, tmp_path):
    texts = {"a__offset-0.json": "{\"é\": [1,\n 2]}", "007.json": "[]", "with space+plus%41.json": "x" * 100_000}
    folder = str(tmp_path / "in")
    feed.write_page_files(pages_frame(spark, list(texts.items())), folder)
    write_page(folder, "notes.txt", "no page")
    (tmp_path / "in" / "older").mkdir()
    write_page(tmp_path / "in" / "older", "b.json", "{}")
    got = feed.scan_pages(spark, folder).collect()
    assert {r["source_file"]: r["value"] for r in got} == {n: t + "\n" for n, t in texts.items()} and len(got) == 3


def outputs(batch):
    order = lambda df: sorted(map(str, df.collect()))
    return {n: order(getattr(batch, n)()) for n in ("events", "performers", "venues", "event_performers", "event_venues", "market", "windows", "raw_archive")}


def test_tables_rebuilt_from_the_archive_equal_the_loaded_ones(spark, tmp_path):
    pages = [(page_name(0), make_feed_file([make_event({"id": 1, "title": "a"}), make_event({"id": 2, "venue": None}), make_event({"id": None})])),
             (page_name(100), make_feed_file([make_event({"id": 1, "title": "b", "event_datetime": "soon"}), make_event({"id": "x"})])), ("cut.json", "{")]
    loaded = ingest.build_batch(pages_frame(spark, pages), "run-1", DAY)
    archive = loaded.raw_archive(keep_ord=True)
    assert outputs(ingest.replay_batch(archive)) == outputs(loaded)
    store = TableStore(spark, str(tmp_path / "store"))
    for run, day, ids in (("r1", 2, (1, 2)), ("r2", 3, (2, 3))):
        feed_pages = [(page_name(100 * day), make_feed_file([make_event({"id": i, "title": f"{run} {i}"}) for i in ids]))]
        pipeline.run_batch(spark, pages_frame(spark, feed_pages), store, run, "", datetime(2027, 1, day))
    t = pipeline.load_tables(store, run_id=pipeline.ALL_RUNS)
    again = ingest.replay_batch(pipeline.read_table(store, "raw_events", keep_ord=True))
    for name, frame in (("events", t.events), ("market", t.market), ("windows", t.windows), ("venues", t.venues)):
        cols = sorted(frame.columns)
        assert sorted(map(str, getattr(again, name)().select(*cols).collect())) == sorted(map(str, frame.select(*cols).collect())), name


def test_payloads_are_read_as_variants(spark):
    texts = [json.dumps(make_event({"id": 4})), json.dumps({"id": "4", "title": None}), "{", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, raw_json string")
    got = {r["k"]: r["p"].asDict() for r in df.select("k", ingest.read_payload(F.col("raw_json")).alias("p")).collect()}
    assert got[0]["id"] == 4 and got[0]["title"] == "Test Event" and got[0]["stats_total_quantity_of_tickets"] == 60
    assert got[1]["id"] == 4 and got[1]["title"] is None and set(got[2].values()) == set(got[3].values()) == {None}


@pytest.mark.parametrize("table", ["raw_events"])
def test_an_interrupted_load_continues_where_it_failed(spark, tmp_path, monkeypatch, table):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(5):
        write_page(folder, page_name(100 * n), make_feed_file([make_event({"id": n + 1})], offset=100 * n))
    write_page(folder, "cut.json", "{")
    write = TableStore.append_delta
    tags, left = [], [1]

    def append_delta(self, name, df, tag, *a, **kw):
        if name == table and tag.endswith("-b1") and left:
            left.pop()
            raise RuntimeError("executor host gone")
        if name == "page_log":
            tags.append(tag)
        write(self, name, df, tag, *a, **kw)

    monkeypatch.setattr(TableStore, "append_delta", append_delta)
    broken, whole = TableStore(spark, str(tmp_path / "broken")), TableStore(spark, str(tmp_path / "whole"))
    load = lambda store, ckpt: incremental_load(spark, str(folder), store, str(tmp_path / ckpt), "run", DAY, max_files=2).first()
    with pytest.raises(StreamingQueryException, match="executor host gone"):
        load(broken, "ckpt-a")
    ledger = load(TableStore(spark, str(tmp_path / "broken")), "ckpt-a")
    assert sorted(set(tags)) == ["run-b0", "run-b1", "run-b2"] and tags.count("run-b0") == tags.count("run-b2") == 1
    numbers = lambda r: (r["files_found"], r["files_loaded"], r["events_loaded"], r["status"])
    assert numbers(ledger) == numbers(load(whole, "ckpt-b")) == (6, 5, 5, "success")
    for name in ("events", "market", "windows", "venues", "raw_events", "feed_files", "page_log", "batch_metrics", "event_venues"):
        a, b = (pipeline.read_table(TableStore(spark, str(tmp_path / s)), name) for s in ("broken", "whole"))
        cols = sorted(a.columns)
        skip = ["source_file", "tag", "run_id", "valid", "reason"] if name in ("page_log",) else cols
        if name == "batch_metrics":
            assert {tuple(r) for r in a.groupBy().sum().collect()} == {tuple(r) for r in b.groupBy().sum().collect()}
        else:
            skip = [c for c in skip if c in cols]
            assert sorted(map(str, a.select(*skip).collect())) == sorted(map(str, b.select(*skip).collect())), name


def test_ledger_counts_come_from_the_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    pages = [(page_name(0), make_feed_file([make_event({"id": 1}), make_event({"id": None})])), ("cut.json", "{"), ("none.json", make_feed_file())]
    batch = ingest.build_batch(pages_frame(spark, pages), "r", DAY)
    assert pipeline.write_page_log(batch, store, "r", "t") == ("r", "t", 3, 2, 1)
    empty = ingest.build_batch(pages_frame(spark, pages).limit(0), "r", DAY)
    assert pipeline.write_page_log(empty, store, "r", "none") == ("r", "none", 0, 0, 0)
    assert pipeline.read_table(store, "page_log").count() == 3


def test_sink_digests_and_isolation(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "a|b", None), (2, -1.25, None, DAY), (2, -1.25, None, DAY)], "n int, x double, s string, t timestamp")
    sets = {"one": lambda: df, "same": lambda: df.orderBy(F.desc("n")).repartition(3), "other": lambda: df.where("n = 1"), "empty": lambda: df.limit(0),
            "unplanned": lambda: df.select("nothing"), "late": lambda: df.select(F.raise_error(F.lit("disk gone")).alias("x"))}
    got = sink.sink_result_sets(sets, str(tmp_path / "out"), "parquet")
    assert got["one"] == got["same"] and got["one"].rows == 3 and got["other"].digest != got["one"].digest and got["empty"] == sink.Written(0, "0")
    assert got["unplanned"].rows is None and "nothing" in got["unplanned"].error and "disk gone" in got["late"].error
    assert spark.read.parquet(str(tmp_path / "out" / "one")).count() == 3
    words = sink.write_result_sets({"late": sets["late"], "one": sets["one"]}, str(tmp_path / "again"))
    assert words["one"] == "ok" and words["late"].startswith("failed: ")


@pytest.mark.parametrize("quantity, raw", [(None, None), (0, 0.0), (7, None), (None, 3.0), (-4, 2.0)])
def test_scores_without_scales_in_both_engines(spark, quantity, raw):
    """R04 where nothing moved or no quantity is known: the operator and the SQL of the oracle agree with the rule."""
    p = Params(as_of=datetime(2027, 1, 1))
    ntz = datetime(2027, 1, 3)
    frames = {
        "market": spark.createDataFrame([(f"r:{i}", "r", i, 10.0 * i, quantity, ntz, False, -1.0) for i in (1, 2)],
                                        "state_id string, run_id string, event_id long, get_in_price double, stats_total_quantity int, "
                                        "stats_last_updated_at timestamp_ntz, forecast_is_available boolean, forecast_value double"),
        "events": spark.createDataFrame([(i, "t", "c", "n", ntz) for i in (1, 2)],
                                        "event_id long, title string, category_type string, event_category_name string, event_utc_datetime timestamp_ntz"),
        "event_venues": spark.createDataFrame([(i, "v") for i in (1, 2)], "event_id long, venue_slug string"),
        "venues": spark.createDataFrame([("v", "hall", "city", None, "x")], "venue_slug string, venue_name string, city string, state string, country string"),
        "windows": spark.createDataFrame([] if raw is None else [("w", "r", 1, 3, raw, False)],
                                         "window_id string, run_id string, event_id long, window_days int, raw_change double, insufficient_data boolean"),
    }
    none = frames["events"]
    t = FeedTables(feed_files=none, raw_events=none, performers=none, event_performers=none, **frames)
    got = {r["event_id"]: (r["supply_score"], r["movement_score"]) for r in scoring.component_scores(t, p).collect()}
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(f"v_{name}", df.toArrow())
    parts = ", ".join(f"{n} AS ({sql})" for n, sql in SCORE_VIEWS.items())
    sql = con.execute(f"WITH {parts} {SCORING['component_scores']}".replace("TIMESTAMP '2001-07-01 00:00:00'", "TIMESTAMP '2027-01-01 00:00:00'"))
    names = [d[0] for d in sql.description]
    want = {r[names.index("event_id")]: (r[names.index("supply_score")], r[names.index("movement_score")]) for r in sql.fetchall()}
    moved = (0.0, 0.0) if not raw else (1.0, 0.0)
    supply = 0.0  # the only quantity is the largest; unknown and no positive ones score 0 too
    assert got == want == {1: (supply, moved[0]), 2: (supply, moved[1])}
