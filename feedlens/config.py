"""Parameters and fixed values shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# ---------------------------------------------------------------------------
# These must equal the values used by the reference pipeline,
# otherwise results differ.
# ---------------------------------------------------------------------------
SENTINEL_FORECAST_VALUES = (-1.0, -100.0)
SUSPICIOUS_PRICE_PCT = 100.0
STALE_HOURS = 48
FILES_PER_COMMIT = 10
WINDOW_DAYS = (3, 7, 14, 30)
PAGE_STATUS_OK = "success"
FILE_KEY_HEX_CHARS = 16
OFFSET_MARKER = "offset-"
# review score weights: price, supply, movement, forecast, urgency, staleness
SCORE_WEIGHTS = {
    "price": 0.25,
    "supply": 0.20,
    "movement": 0.25,
    "forecast": 0.15,
    "urgency": 0.10,
    "staleness": 0.05,
}
# urgency: (first day, last day, score); anything else scores URGENCY_DEFAULT
URGENCY_BUCKETS = ((0, 7, 1.0), (8, 14, 0.7), (15, 30, 0.4))
URGENCY_DEFAULT = 0.1
# staleness: hours since update strictly above threshold -> score
STALENESS_STEPS = ((48, 1.0), (24, 0.5))
STALENESS_DEFAULT = 0.0
SEVERITY_RANK = {"ERROR": 1, "WARNING": 2}  # anything else ranks 3
TOP_PRICE_N = 20
TOP_QUANTITY_N = 20
TOP_MOVEMENT_N = 20
TOP_VENUE_N = 50
VENUE_MIN_EVENTS = 2
REVIEW_TOP_N = 100
DQ_SAMPLE_ROWS = 10


@dataclass(frozen=True)
class Params:
    """Run parameters. ``as_of`` replaces CURRENT_TIMESTAMP so results are
    reproducible; ``ntz`` says whether the tables carry TIMESTAMP_NTZ."""

    as_of: datetime = field(default_factory=lambda: datetime(2001, 7, 1))
    ntz: bool = True
    run_id: str | None = None          # None = latest successful run
    stale_hours: int = STALE_HOURS
    suspicious_pct: float = SUSPICIOUS_PRICE_PCT
    sentinels: tuple = SENTINEL_FORECAST_VALUES
    # median: "distributed" (exact, rank selection, no per-group state),
    # "percentile" (exact, one task holds a group's distinct values),
    # "approx" (percentile_approx sketch)
    median: str = "distributed"

    @property
    def as_of_sql(self) -> str:
        return self.as_of.strftime("%Y-%m-%d %H:%M:%S")
