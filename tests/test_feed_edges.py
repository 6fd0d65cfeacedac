"""Edge cases beyond the reference's tests (FIXTURES.md, 'Added by us')."""

from datetime import datetime

from feed_pages import make_event, make_feed_file, page_name, pages_frame
from feedlens.operators.ingest import build_batch

T0 = datetime(2026, 5, 27, 17, 0)


def batch_of(spark, pages):
    return build_batch(pages_frame(spark, pages), "run-1", T0)


def test_duplicate_id_across_pages_keeps_first_datetime_and_last_title(spark):
    # file-name order: offset-100 < offset-1000 < offset-200 (lexicographic, as a sorted listing)
    pages = [
        (page_name(200), make_feed_file([make_event({"id": 7, "title": "third",
                                                     "event_datetime": "2026-06-03T00:00:00Z"})])),
        (page_name(100), make_feed_file([make_event({"id": 7, "title": "first",
                                                     "event_datetime": "2026-06-01T00:00:00Z"})])),
        (page_name(1000), make_feed_file([make_event({"id": 7, "title": "second",
                                                      "event_datetime": "2026-06-02T00:00:00Z"})])),
    ]
    b = batch_of(spark, pages)
    ev = b.events().collect()
    assert len(ev) == 1
    assert ev[0]["title"] == "third"                      # latest by file order
    assert ev[0]["event_datetime"] == datetime(2026, 6, 1)  # first by file order
    assert b.market().count() == 1 and b.raw_archive().count() == 3


def test_empty_and_absent_windows_emit_no_rows(spark):
    e = make_event({"id": 1, "30day_price_change": {}, "7day_price_change": None})
    del e["3day_price_change"]
    b = batch_of(spark, [(page_name(0), make_feed_file([e]))])
    rows = {r["window_days"]: r for r in b.windows().collect()}
    assert set(rows) == {14}
    part = make_event({"id": 2, "3day_price_change": {"insufficient_data": None}})
    rows2 = {r["window_days"]: r for r in batch_of(spark, [(page_name(0), make_feed_file([part]))]).windows().collect()}
    assert rows2[3]["insufficient_data"] is False and rows2[3]["direction"] is None


def test_id_zero_and_slug_without_name(spark):
    events = [make_event({"id": 0}), make_event({"id": 5, "performer": None}),
              make_event({"id": 6, "venue": ""})]
    b = batch_of(spark, [(page_name(0), make_feed_file(events))])
    q = b.quarantine_events().collect()
    assert [(r["reason"], r["event_id"]) for r in q] == [("missing id", "0")]
    assert sorted(r["event_id"] for r in b.event_performers().collect()) == [6]
    assert sorted(r["event_id"] for r in b.event_venues().collect()) == [5]
    assert b.events().count() == 2


def test_unparseable_date_and_null_quantity(spark):
    e = make_event({"id": 9, "event_datetime": "soon", "stats_total_quantity_of_tickets": None,
                    "event_utc_datetime": ""})
    b = batch_of(spark, [(page_name(0), make_feed_file([e]))])
    ev = b.events().first()
    assert ev["event_datetime"] is None and ev["event_datetime_raw"] == "soon"
    assert ev["event_utc_datetime"] is None
    assert b.market().first()["stats_total_quantity"] is None


def test_bad_event_type_is_quarantined_not_raised(spark):
    events = [make_event({"id": "abc"}), make_event({"id": 4})]
    b = batch_of(spark, [(page_name(0), make_feed_file(events))])
    assert [r["reason"] for r in b.quarantine_events().collect()] == ["event parse error"]
    assert [r["event_id"] for r in b.events().collect()] == [4]


def test_castable_fields_keep_the_event(spark):
    odd = [{"id": "777"}, {"get_in_price": "150.0"}, {"forecast_value": "-100"}, {"stats_total_quantity_of_tickets": 200.0},
           {"mock_data_point": False}, {"forecast_is_available": 1}, {"get_in_price": "cheap"}, {"3day_price_change": "none"}]
    events = [make_event({"id": 100 + n} | o) for n, o in enumerate(odd)]
    b = batch_of(spark, [(page_name(0), make_feed_file(events))])
    assert b.quarantine_events().count() == 0
    rows = {r["event_id"]: r for r in b.market().collect()}
    assert sorted(rows) == [101, 102, 103, 104, 105, 106, 107, 777]
    assert rows[101]["get_in_price"] == 150.0 and rows[102]["forecast_value"] == -100.0 and rows[103]["stats_total_quantity"] == 200
    assert rows[104]["mock_data_point"] == 0 and rows[105]["forecast_is_available"] is True and rows[106]["get_in_price"] is None
    from feedlens.sources import feed
    parsed = feed.parse_events(feed.explode_events(feed.parse_pages(pages_frame(spark, [(page_name(0), make_feed_file(events))]))))
    assert {r["id"]: r["cast_failures"] for r in parsed.collect() if r["cast_failures"]} == {106: 1, 107: 1}
