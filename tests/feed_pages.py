"""Feed events and pages for the tests."""

from __future__ import annotations

import json
import os

from feedlens.sources import feed

SAMPLE_TEXT = {"city": "Leeds", "state": "WY", "country": "GB", "category_type": "THEATRE", "event_category_name": "Drama",
               "performer_slug": "the-players", "venue_slug": "old-mill", "event_timezone": "BST",
               "date": "Fri, 09/04/2026 08:00 PM", "event_datetime": "2026-09-04T20:00:00Z",
               "event_utc_datetime": "2026-09-04T19:00:00Z", "stats_last_updated_at": "2026-05-27T08:15:00Z"}
SAMPLE_NUMBERS = {"id": 71, "get_in_price": 42.5, "stats_total_quantity_of_tickets": 60, "forecast_value": 0.4,
                  "mock_data_point": 0, "disable_click_through": 0, "forecast_is_available": True,
                  "is_past_with_no_pricing": False}


def make_event(overrides: dict | None = None) -> dict:
    """An event with every field of the event schema, some values replaced."""
    event = {f: SAMPLE_TEXT.get(f, f"some {f}") for f in feed.TEXT_FIELDS} | SAMPLE_NUMBERS
    for n, field in enumerate(feed.WINDOW_FIELDS):
        event[field] = {"direction": "down" if n % 2 else "up", "raw": (-1) ** n * (n + 1.0), "percent": (-1) ** n * 4.0,
                        "insufficient_data": False}
    return event | {"title": "Test Event"} | (overrides or {})


def make_feed_file(events: list | None = None, status: str = "success", offset: int = 0) -> dict:
    """A page around ``events``: the header's counts follow from them."""
    shown = list(events or [])
    counts = dict.fromkeys(("total_count", "upcoming_count"), len(shown)) | {"past_count": 0, "current_utc": "2026-05-27T09:00:00Z"}
    paging = dict.fromkeys(("current_page_results", "total_database_matches"), len(shown)) | {
        "offset": offset, "limit": 100, "has_more": False, "tab_requested": None}
    dates = {"start_date": "2026-05-27", "end_date": "2026-06-26", "is_any": False}
    metadata = {"pagination": paging, "categorization": counts, "filters": {"date_range": dates}}
    return {"status": status, "data": {"metadata": metadata, "events": {"all": shown}}}


def page_name(offset: int) -> str:
    return f"2026-05-27_to_2026-06-26__offset-{offset}.json"


def write_page(directory, name: str, data) -> str:
    path = os.path.join(str(directory), name)
    with open(path, "w") as f:
        f.write(data if isinstance(data, str) else json.dumps(data))
    return path


def pages_frame(spark, pages: list[tuple[str, object]]):
    rows = [(n, d if isinstance(d, str) else json.dumps(d)) for n, d in pages]
    return spark.createDataFrame(rows, "source_file string, value string")
