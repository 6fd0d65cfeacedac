from feedlens.functions.columns import (  # noqa: F401
    as_of_lit,
    days_until,
    epoch_seconds,
    file_key,
    hour_boundaries_between,
    hours_between,
    is_real_forecast,
    normalise_ts,
    offset_from_name,
    round_half_away,
)
