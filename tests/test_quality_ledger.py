"""Report ordering, ledger state and ingest-DQ formatting."""

import dataclasses
from datetime import datetime

from pyspark.sql import functions as F

from feedlens.operators import ledger, quality


def test_dq_report_order(spark):
    rows = [("a", "INFO", "FAIL", 5), ("b", "ERROR", "FAIL", 1), ("c", "ERROR", "PASS", 0),
            ("d", "WARNING", "FAIL", 9), ("e", "WARNING", "FAIL", 30), ("f", "WARNING", "PASS", 0),
            ("g", "INFO", "PASS", 0)]
    dq = spark.createDataFrame(rows, "check_name string, severity string, status string, affected_count long")
    got = [r["check_name"] for r in quality.dq_report(dq).collect()]
    assert got == ["c", "b", "f", "e", "d", "g", "a"]


def test_latest_successful_run_ignores_running_and_failed(spark):
    rows = [("r1", datetime(2026, 1, 1), None, "running"), ("r1", datetime(2026, 1, 1), datetime(2026, 1, 1, 1), "success"),
            ("r2", datetime(2026, 1, 2), None, "running"),
            ("r3", datetime(2026, 1, 3), None, "running"), ("r3", datetime(2026, 1, 3), datetime(2026, 1, 3, 1), "failed")]
    led = spark.createDataFrame(rows, "run_id string, started_at timestamp, finished_at timestamp, status string")
    states = {r["run_id"]: r["status"] for r in ledger.current_runs(led).collect()}
    assert states == {"r1": "success", "r2": "running", "r3": "failed"}
    assert ledger.latest_successful_run(led).first()["run_id"] == "r1"


def test_ingest_dq_rows_format(spark):
    files = spark.createDataFrame([("b.json", "JSON parse error"), ("a.json", "missing data.events")],
                                  "source_file string, reason string")
    events = spark.createDataFrame([], "source_file string, reason string, event_id string")
    reasons = ledger.ingest_dq_reasons(files, events)
    rows = {r["check_name"]: r for r in ledger.ingest_dq_rows(reasons, F.lit("run-1"), F.current_timestamp()).collect()}
    f, e = rows["malformed_files"], rows["malformed_events"]
    assert (f["status"], f["affected_count"], f["severity"]) == ("FAIL", 2, "ERROR")
    assert f["check_id"] == "run-1:malformed_files" and f["details"] == "2 kinds of reason"
    assert (e["status"], e["affected_count"], e["details"]) == ("PASS", 0, None)


def test_every_reason_is_kept(spark):
    files = spark.createDataFrame([(f"{i}.json", "JSON parse error") for i in range(25)], "source_file string, reason string")
    events = spark.createDataFrame([("a.json", "missing id", "")] * 13, "source_file string, reason string, event_id string")
    assert ledger.ingest_dq_reasons(files, events).groupBy("check_name").count().orderBy("count").collect()[0]["count"] == 13
    assert ledger.ingest_dq_reasons(files, events).count() == 38


def test_one_broken_check_leaves_the_others(spark):
    from feedlens.config import Params
    from feedlens.sources.driver import driver_tables
    p = Params()
    t = driver_tables(spark, "/root/testdata/sf0.001", p)
    want = {r["check_name"]: r["affected_count"] for r in quality.dq_suite(t, p).collect()}
    t = dataclasses.replace(t, market=t.market.drop("mock_data_point"))
    got = {r["check_name"]: (r["affected_count"], r["status"]) for r in quality.dq_suite(t, p).collect()}
    assert got.pop("mock_data_points_present") == (-1, "FAIL")
    assert all(want[k] == n for k, (n, _) in got.items()) and len(got) == 21
