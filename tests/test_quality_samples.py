"""Check samples, thresholds, isolation and states per run."""

import dataclasses
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feed_pages import make_event, make_feed_file, page_name, pages_frame
from feedlens.config import Params
from feedlens.operators import quality
from feedlens.plans import pipeline
from feedlens.sources.driver import driver_tables
from feedlens.sources.store import TableStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark):
    p = Params()
    return driver_tables(spark, SF, p), p


def rows(df):
    return {r["check_name"]: r.asDict() for r in df.collect()}


def test_samples_are_cut_before_the_shuffle_and_read_a_table_once(world, capsys):
    t, p = world
    market = [k for k in quality.SUITE_ORDER if quality.ROW_BY_KEY[k].source == "market"]
    quality.check_samples(t, p, market).explain("formatted")
    plan = capsys.readouterr().out
    tree = plan[plan.index("== Physical Plan"):plan.index("(1)", plan.index("\n\n"))]
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert tree.count("Scan parquet") == 2 and len(market) == 8  # orders and lineitem, once each


def test_details_show_at_most_ten_rows_in_order(world):
    t, p = world
    got = rows(quality.dq_suite(t, p))
    assert list(got["price_change_direction_sign_match"]) == ["check_name", "severity", "status", "affected_count", "details"]
    stale = got["stats_last_updated_stale"]["details"].split("; ")
    assert len(stale) == 10 and [x.split(", ")[1] for x in stale] == sorted(x.split(", ")[1] for x in stale)
    assert all((r["details"] is None) == (r["status"] == "PASS") for r in got.values())
    few = got["event_utc_datetime_parseable"]
    assert few["affected_count"] == len(few["details"].split("; ")) < 10


def test_thresholds_by_check(world):
    t, p = world
    n = rows(quality.dq_suite(t, p))["get_in_price_numeric"]["affected_count"]
    got = rows(quality.dq_suite(t, p, {"get_in_price_numeric": n, "stats_last_updated_stale": 3}))
    assert got["get_in_price_numeric"] | {"status": "PASS", "details": None} == got["get_in_price_numeric"]
    assert got["stats_last_updated_stale"]["status"] == "FAIL"
    lazily = rows(quality.run_checks(t, p, ["dq_price_present", "dq_price_zero"], {"get_in_price_numeric": n - 1}))
    assert {r["status"] for r in lazily.values()} == {"FAIL"}


def test_errors_while_running_stay_with_their_check(world):
    t, p = world
    want = rows(quality.dq_suite(t, p))
    market = t.market.withColumn("mock_data_point", F.when(F.col("event_id") > 0, F.raise_error(F.lit("lost column file"))).cast("int"))
    events = t.events.drop("event_datetime_raw")
    got = rows(quality.dq_suite(dataclasses.replace(t, market=market, events=events), p))
    for name, said in (("mock_data_points_present", "lost column file"), ("event_datetime_parseable", "event_datetime_raw")):
        bad = got.pop(name)
        assert (bad["status"], bad["affected_count"]) == ("FAIL", -1) and bad["details"].startswith("Check error: ") and said in bad["details"]
    assert len(got) == 20 and all(want[k] == r for k, r in got.items())


def test_rows_that_cannot_be_shown_fail_the_check(world):
    t, p = world
    files = t.feed_files.withColumn("feed_status", F.when(F.col("feed_status") != "success", F.col("feed_status")).otherwise("success"))
    broken = dataclasses.replace(t, feed_files=files.withColumn("limit_per_page", F.when(F.col("offset") >= 0, F.raise_error(F.lit("no limit"))).cast("int")))
    got = rows(quality.dq_suite(broken, p))
    assert got["pagination_offset_gaps"]["affected_count"] == -1 and "no limit" in got["pagination_offset_gaps"]["details"]
    assert got["feed_status_success"] == rows(quality.dq_suite(t, p))["feed_status_success"]


def test_summary_lists_what_failed(world):
    t, p = world
    dq = quality.run_checks(t, p)
    failed = {(r["severity"], r["status"]): r["failing"] for r in quality.dq_summary(dq).collect()}
    assert all((text is None) == (status == "PASS") for (_, status), text in failed.items())
    want = sorted(f"{r['check_name']} ({r['affected_count']})" for r in dq.collect() if r["status"] == "FAIL" and r["severity"] == "ERROR")
    assert failed["ERROR", "FAIL"] == "; ".join(want)


def test_states_of_runs_equal_a_scan_of_all(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))

    def load(run, day, prices):
        events = [make_event({"id": i, "get_in_price": price, "3day_price_change": {"direction": "up", "raw": 5, "percent": 90.0 + 40 * i}})
                  for i, price in enumerate(prices, 1)]
        pipeline.run_batch(spark, pages_frame(spark, [(page_name(0), make_feed_file(events))]), store, run, "", datetime(2026, 5, day))

    load("r1", 27, [0, 5, 0])
    load("r2", 28, [0, None, 7, 0])
    p = Params(as_of=datetime(2026, 6, 1), ntz=False)
    seen = []
    states = quality.check_states
    monkeypatch.setattr(quality, "check_states", lambda t, own, keys=None: seen.append(own.run_id) or states(t, own, keys))

    def both(runs):
        t = pipeline.load_tables(store, run_id=pipeline.ALL_RUNS)
        got, whole = rows(pipeline.runs_suite(spark, t, store, runs, p)), rows(quality.dq_suite(t, p))
        assert got and got == {k: whole[k] for k in got}
        return got

    assert both(["r1", "r2"])["get_in_price_zero_flagged"]["affected_count"] == 4
    load("r3", 29, [0] * 30)
    del seen[:]
    got = both(["r1", "r2", "r3"])
    assert seen[0] == "r3" and "r1" not in seen and "r2" not in seen  # the full scan asks for no run
    assert got["get_in_price_zero_flagged"]["affected_count"] == 34 and len(got["get_in_price_zero_flagged"]["details"].split("; ")) == 10
