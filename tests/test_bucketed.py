"""Merges into bucketed tables against the merges of whole frames."""

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedlens.operators import merge
from feedlens.sources.bucketed import BucketedTable

RULES = merge.MergeRules(key=("id",), latest=("title",), first=("born",))
BUCKETS = 8


def delivery(spark, day, rows):
    df = spark.createDataFrame([(i, t, f"{t} of {day}") for i, t in rows], "id long, title string, born string")
    ts = F.lit(datetime(2027, 1, day))
    o = merge.ordinal(ts, F.lit(f"file-{day}"), F.monotonically_increasing_id())
    return df.withColumns({"first_seen_at": ts, "last_seen_at": ts, merge.FIRST_ORD: o, merge.LAST_ORD: o})


@pytest.fixture
def table(spark, tmp_path):
    name = "b_" + re.sub(r"\W", "_", tmp_path.name)
    yield BucketedTable(spark, name, str(tmp_path / "t"), ["id"], BUCKETS)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, df.select(*cols).collect()))


def files(tmp_path):
    return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, table, tmp_path):
    base = delivery(spark, 2, [(i, f"t{i}") for i in range(400)])
    few = delivery(spark, 3, [(7, "seven"), (7, "VII"), (1000, "new")])
    early = delivery(spark, 1, [(7, "first"), (8, "before")])
    assert table.upsert(base, RULES) == list(range(BUCKETS))
    before = files(tmp_path)
    touched = table.upsert(few, RULES)
    assert 1 <= len(touched) <= 2
    changed = {f for f, t in files(tmp_path).items() if before.get(f) != t}
    assert {int(re.search(r"_bucket=(\d+)", f).group(1)) for f in changed} == set(touched)
    table.upsert(early, RULES)
    want = merge.upsert(merge.upsert(merge.upsert(None, base, RULES), few, RULES), early, RULES)
    assert rows(table.read()) == rows(want) and table.read().count() == 401
    seven = table.read().where("id = 7").first()
    assert (seven["title"], seven["born"], seven["first_seen_at"].day, seven["last_seen_at"].day) == ("VII", "first of 1", 1, 3)
    table.upsert(few, RULES)  # a replay changes nothing
    assert rows(table.read()) == rows(want)


def test_stored_rows_are_not_shuffled(spark, table, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.upsert(delivery(spark, 2, [(i, "x") for i in range(100)]), RULES)
        batch = delivery(spark, 3, [(5, "y")])
        touched = table.touched(batch)
        for df in (table.merged(batch, RULES, touched), table.absent(batch, merge.LAST_ORD, touched)):
            df.explain()
            plan = capsys.readouterr().out
            lines = plan.splitlines()
            scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            above, at = [], depth(lines[scan])
            for line in reversed(lines[:scan]):
                if depth(line) < at:
                    above.append(line)
                    at = depth(line)
            assert "Join" in "".join(above) and not any("Exchange" in line for line in above), plan
            assert "Bucketed: true" in plan and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in plan and "PartitionFilters: [" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insert_if_absent_adds_and_keeps(spark, table, tmp_path):
    first = delivery(spark, 2, [(i, "x") for i in range(50)])
    table.insert_if_absent(first, merge.FIRST_ORD)
    before = files(tmp_path)
    again = delivery(spark, 3, [(49, "no"), (50, "yes"), (50, "later")])
    table.insert_if_absent(again, merge.FIRST_ORD)
    assert before.items() <= files(tmp_path).items()
    want = merge.first_wins(first, ["id"], merge.FIRST_ORD)
    want = want.unionByName(merge.insert_if_absent(want, again, ["id"], merge.FIRST_ORD))
    assert rows(table.read()) == rows(want) and {r["title"] for r in table.read().where("id >= 49").collect()} == {"x", "yes"}
    assert table.insert_if_absent(again.limit(0), merge.FIRST_ORD) == []


def test_a_rewrite_cut_off_is_finished_on_opening(spark, table, monkeypatch):
    base, later = delivery(spark, 2, [(i, "x") for i in range(40)]), delivery(spark, 3, [(i, "y") for i in range(10)])
    table.upsert(base, RULES)
    monkeypatch.setattr(BucketedTable, "_replace", lambda self, rows: (_ for _ in ()).throw(RuntimeError("driver gone")))
    with pytest.raises(RuntimeError, match="driver gone"):
        table.upsert(later, RULES)
    monkeypatch.undo()
    spark.sql(f"DROP TABLE {table.name}")  # another session knows the files alone
    assert Path(table.path).exists() and table.open() and table._pending() is None
    assert rows(table.read()) == rows(merge.upsert(merge.upsert(None, base, RULES), later, RULES))
