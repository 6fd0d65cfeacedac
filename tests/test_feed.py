"""Feed parsing and loading, one table of inputs and expected rows per operator of SURVEY §2."""

import hashlib
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feed_pages import make_event, make_feed_file, page_name, pages_frame, write_page
from feedlens.functions.columns import file_key, lenient_bool, lenient_int, normalise_ts, offset_from_name
from feedlens.operators.ingest import build_batch
from feedlens.plans import pipeline
from feedlens.sources import feed
from feedlens.sources.store import TableStore

DAY = datetime(2027, 3, 4, 5, 6, 7)


def values(spark, expr, texts):
    """``expr`` over all texts in one frame, in their order."""
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    return [r["r"] for r in df.select("k", expr(F.col("v")).alias("r")).orderBy("k").collect()]


COLUMN_CASES = {
    "S06 offset": (offset_from_name, {
        "a__offset-1300.json": 1300, "offset-7": 7, "deep/offset-2/x__offset-40.json": 40, "__offset-.json": None, "offset-9x.json": None,
        "plain.json": None, "": None, None: None, f"offset-{2**40}.json": 2**40}),
    "S07 key": (file_key, {n: hashlib.sha256(n.split("/")[-1].encode()).hexdigest()[:16] for n in ("p.json", "dir/p.json", "é.json")}),
    "S08 timestamp": (normalise_ts, {
        "2027-03-04T05:06:07Z": DAY, "2027-03-04T06:06:07+01:00": DAY, " 2027-03-04 05:06:07 ": DAY, "2027-03-04": datetime(2027, 3, 4),
        "tomorrow": None, "2027-13-01T00:00:00Z": None, "   ": None, None: None}),
    "integers": (lenient_int, {"12": 12, "12.6": 13, "true": 1, "-3": -3, "x": None, None: None}),
    "booleans": (lenient_bool, {"true": True, "0": False, "2.5": True, "no": False, "maybe": None, None: None}),
}


@pytest.mark.parametrize("name", COLUMN_CASES)
def test_column_rules(spark, name):
    expr, cases = COLUMN_CASES[name]
    assert values(spark, expr, cases) == list(cases.values())


def edited(**changes):
    """A page with keys of the document or of its data replaced; ... removes one."""
    page = make_feed_file([make_event({"id": 5})])
    for key, value in changes.items():
        where = page if key in page else page["data"]
        where[key] = value
        if value is ...:
            del where[key]
    return page


# name -> (page, reason it is rejected for, ids of its events if it is not)
PAGES = {
    "object.json": (make_feed_file([make_event({"id": 8}), make_event({"id": 3})]), None, [8, 3]),
    "list.json": (edited(events=[make_event({"id": 6})]), None, [6]),
    "none.json": (make_feed_file(), None, []),
    "null-events.json": (edited(events=None), None, []),
    "text-events.json": (edited(events="soon"), None, []),
    "other-key.json": (edited(events={"past": [make_event()]}), None, []),
    "extra.json": (edited() | {"more": [1, {"a": 2}]}, None, [5]),
    "failed.json": (edited(status="degraded"), "status != success (got 'degraded')", None),
    "unstated.json": (edited(status=...), "status != success (got None)", None),
    "no-data.json": (edited(data=...), "missing top-level 'data' key", None),
    "null-data.json": (edited(data=None), "missing top-level 'data' key", None),
    "no-metadata.json": (edited(metadata=...), "missing data.metadata", None),
    "bare.json": (edited(metadata=..., events=...), "missing data.metadata; missing data.events", None),
    "both.json": (edited(status="x", events=...), "status != success (got 'x'); missing data.events", None),
    "cut.json": (json.dumps(edited())[:60], "JSON parse error", None),
    "array.json": ([edited()], "JSON parse error", None),
    "empty.json": ("", "JSON parse error", None),
}


@pytest.fixture(scope="module")
def parsed(spark):
    return feed.parse_pages(pages_frame(spark, [(name, page) for name, (page, _, _) in PAGES.items()])).persist()


def test_pages_are_kept_or_rejected_with_all_reasons(parsed):  # S02, S03
    got = {r["source_file"]: (r["valid"], r["reason"], len(r["errors"])) for r in parsed.collect()}
    assert {n: g[:2] for n, g in got.items()} == {n: (reason is None, reason) for n, (_, reason, _) in PAGES.items()}
    assert got["both.json"][2] == 2 and got["cut.json"][0] is False
    assert {tuple(r) for r in feed.quarantined_pages(parsed).collect()} == {(n, reason) for n, (_, reason, _) in PAGES.items() if reason}


def test_events_keep_their_place(parsed):  # S04
    got = {}
    for r in feed.parse_events(feed.explode_events(parsed)).orderBy("pos").collect():
        got.setdefault(r["source_file"], []).append(r["id"])
    assert got == {n: ids for n, (_, _, ids) in PAGES.items() if ids}


def test_headers(spark):  # S05
    full = make_feed_file([make_event({"id": i}) for i in (1, 2)], offset=700)
    paging = full["data"]["metadata"]["pagination"]
    paging.update(total_database_matches=2**35, has_more=True, tab_requested="sports")
    odd = make_feed_file()
    odd["data"]["metadata"] = {"filters": {"date_range": {"start_date": "someday", "end_date": "2027-01-02"}}}
    pages = feed.parse_pages(pages_frame(spark, [(page_name(700), full), ("odd.json", odd), ("cut.json", "{")]))
    rows = {r["source_file"]: r.asDict() for r in feed.page_headers(pages, F.lit("r9"), F.lit(DAY)).collect()}
    assert set(rows) == {page_name(700), "odd.json"}
    want = {"run_id": "r9", "offset": 700, "feed_status": "success", "total_db_matches": 2**35, "current_page_results": 2, "has_more": True,
            "limit_per_page": 100, "tab_requested": "sports", "date_filter_start": date(2026, 5, 27), "upcoming_count": 2, "past_count": 0, "loaded_at": DAY}
    assert want.items() <= rows[page_name(700)].items()
    nothing = {"offset": None, "total_db_matches": None, "has_more": False, "date_filter_start": None, "date_filter_end": date(2027, 1, 2), "total_count": None}
    assert nothing.items() <= rows["odd.json"].items()


# an event's changes -> what is loaded of it: rows of events, performers, venues, bridges (both), market, windows; or why it is not
EVENTS = [
    ({}, (1, 1, 1, 2, 1, 4)),
    ({"performer": None}, (1, 0, 1, 1, 1, 4)),
    ({"performer_slug": ""}, (1, 0, 1, 1, 1, 4)),
    ({"venue": None, "performer": None}, (1, 0, 0, 0, 1, 4)),
    ({"3day_price_change": None, "7day_price_change": {}}, (1, 1, 1, 2, 1, 2)),
    ({"get_in_price": None, "title": None}, (1, 1, 1, 2, 1, 4)),
    ({"id": None}, "missing id"),
    ({"id": 0}, "missing id"),
    ({"id": "seven"}, "event parse error"),
]


@pytest.mark.parametrize("n", range(len(EVENTS)))
def test_one_event_fills_its_tables(spark, n):  # S09-S15
    changes, want = EVENTS[n]
    b = build_batch(pages_frame(spark, [("p.json", make_feed_file([make_event(changes)]))]), "run", DAY)
    counts = (b.events().count(), b.performers().count(), b.venues().count(), b.event_performers().count() + b.event_venues().count(),
              b.market().count(), b.windows().count())
    bad = [r["reason"] for r in b.quarantine_events().collect()]
    assert (counts, bad) == ((want, []) if isinstance(want, tuple) else ((0, 0, 0, 0, 0, 0), [want]))


def test_snapshot_values(spark):  # S14, S15
    events = [make_event({"id": 1, "get_in_price": 0, "forecast_is_available": False, "forecast_value": -1}),
              make_event({"id": 2, "30day_price_change": {"direction": "flat", "raw": 0, "percent": "0.5", "insufficient_data": True}})]
    b = build_batch(pages_frame(spark, [("p.json", make_feed_file(events))]), "run", DAY)
    price = {r["event_id"]: (r["state_id"], r["get_in_price"], r["forecast_is_available"], r["forecast_value"]) for r in b.market().collect()}
    assert price == {1: ("run:1", 0.0, False, -1.0), 2: ("run:2", 42.5, True, 0.4)}
    moved = {(r["event_id"], r["window_days"]): (r["direction"], r["percent_change"], r["raw_change"], r["insufficient_data"]) for r in b.windows().collect()}
    assert moved[2, 30] == ("flat", 0.5, 0.0, True) and moved[1, 30] == ("down", -4.0, -4.0, False) and len(moved) == 8


class Loads:
    """Deliveries into one store, and what is there after each."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.store = spark, folder, TableStore(spark, str(folder / "store"))

    def deliver(self, run, day, pages):
        place = self.folder / run
        place.mkdir()
        for name, page in pages.items():
            write_page(place, name, page)
        return pipeline.run_batch(self.spark, feed.scan_pages(self.spark, str(place)), self.store, run, str(place), datetime(2027, 1, day)).first()

    def sizes(self):
        t = pipeline.load_tables(self.store)
        return {n: df.count() for n, df in (("events", t.events), ("market", t.market), ("raw", t.raw_events), ("files", t.feed_files))}


def test_deliveries_add_up(spark, tmp_path):  # W01-W04, W07-W09
    loads = Loads(spark, tmp_path)
    first = {page_name(0): make_feed_file([make_event({"id": 1, "title": "one"}), make_event({"id": 2})]), "cut.json": "{", "note.txt": "no page"}
    ledger = loads.deliver("a", 1, first)
    assert (ledger["status"], ledger["files_found"], ledger["files_loaded"], ledger["events_loaded"]) == ("success", 2, 1, 2)
    assert loads.sizes() == {"events": 2, "market": 2, "raw": 2, "files": 1}
    loads.deliver("b", 2, first)  # the same again: a snapshot more, nothing else
    assert loads.sizes() == {"events": 2, "market": 2, "raw": 2, "files": 1}
    assert pipeline.load_tables(loads.store, run_id=pipeline.ALL_RUNS).market.count() == 4
    ledger = loads.deliver("c", 3, {page_name(0): make_feed_file([make_event({"id": 1, "title": "uno"})]), page_name(100): make_feed_file([make_event({"id": None})])})
    assert (ledger["files_loaded"], ledger["events_loaded"]) == (2, 1)
    assert loads.sizes() == {"events": 2, "market": 1, "raw": 2, "files": 2}
    t = pipeline.load_tables(loads.store)
    seen = {r["event_id"]: (r["title"], r["first_seen_at"].day, r["last_seen_at"].day) for r in t.events.collect()}
    assert seen == {1: ("uno", 1, 3), 2: ("Test Event", 1, 2)}
    wrong = {(r["run_id"], r["check_name"]): (r["status"], r["affected_count"]) for r in t.dq_results.collect()}
    assert wrong["a", "malformed_files"] == ("FAIL", 1) and wrong["c", "malformed_events"] == ("FAIL", 1) and wrong["c", "malformed_files"] == ("PASS", 0)
    kept = pipeline.read_table(loads.store, "event_quarantine").collect()
    assert [(r["run_id"], r["source_file"], r["reason"]) for r in kept] == [("c", page_name(100), "missing id")]
