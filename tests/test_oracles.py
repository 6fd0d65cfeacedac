"""Registered queries against their DuckDB oracles on the smallest driver
tables (the driver's own gate runs every key at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
KEYS = ["events_by_category", "top20_by_price", "median_price_by_venue", "pricing_review", "dq_suite",
        "dq_failing_rows", "kpi_leaders", "counts_by_source_file", "feed_page_header", "unpivot_windows",
        "upsert_partial_columns", "insert_if_absent", "latest_snapshot", "dq_ingest_malformed"]


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as mk
    return mk(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    from oracle_check import compare
    from __spark_entry__ import oracle_sql, queries
    res = compare(spark, duck, key, queries()[key], oracle_sql()[key], SF)
    assert res["status"] == "OK", res


def test_every_key_has_an_oracle():
    from feedlens.plans import registry
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert len(registry.queries()) == 77
    from __spark_entry__ import oracle_sql, queries
    assert set(registry.queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
