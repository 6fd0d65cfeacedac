"""Column-expression helpers. Everything here is a built-in Spark expression,
so it stays inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.config import FILE_KEY_HEX_CHARS, OFFSET_MARKER, Params


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def offset_from_name(name) -> Column:
    """Page offset from a file name: the text after the last ``offset-`` with
    ``.json`` removed, as an integer; NULL when there is no such number."""
    tail = F.element_at(F.split(_c(name), OFFSET_MARKER), -1)
    return F.replace(tail, F.lit(".json"), F.lit("")).try_cast("bigint")


def file_key(name) -> Column:
    """Stable file key: leading hex characters of SHA-256 of the base name."""
    base = F.element_at(F.split(_c(name), "/"), -1)
    return F.substring(F.sha2(base, 256), 1, FILE_KEY_HEX_CHARS)


def normalise_ts(text, ntz: bool = False) -> Column:
    """Feed timestamp text -> timestamp. Empty or unparseable text gives NULL
    (the raw text is kept in a separate column by the callers)."""
    t = F.nullif(F.trim(_c(text)), F.lit(""))
    return t.try_cast("timestamp_ntz" if ntz else "timestamp")


def lenient_double(text) -> Column:
    """JSON scalar text -> double; true and false count as 1 and 0."""
    t = F.lower(_c(text))
    return F.coalesce(_c(text).try_cast("double"), F.when(t == "true", F.lit(1.0)).when(t == "false", F.lit(0.0)))


def lenient_int(text, kind: str = "bigint") -> Column:
    """JSON scalar text -> integer; a fraction is rounded, what does not fit is NULL."""
    return F.coalesce(_c(text).try_cast(kind), F.round(lenient_double(text)).try_cast(kind))


def lenient_bool(text) -> Column:
    """JSON scalar text -> boolean; a number is true unless it is 0."""
    return F.coalesce(_c(text).try_cast("boolean"), lenient_double(text) != F.lit(0.0))


def as_of_lit(params: Params) -> Column:
    return F.lit(params.as_of_sql).cast("timestamp_ntz" if params.ntz else "timestamp")


def round_half_away(col, digits: int) -> Column:
    """ROUND(x, d) as DuckDB computes it for doubles: round(x * 10^d) / 10^d,
    halves away from zero (Spark's round on the scaled value does the same)."""
    scale = float(10 ** digits)
    return F.round(_c(col) * F.lit(scale), 0) / F.lit(scale)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 as a double, for NTZ and LTZ timestamps."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             _c(ts).cast("timestamp_ntz"))
    return micros.cast("double") / F.lit(1e6)


def hours_between(start, end) -> Column:
    """Exact elapsed hours (fractional) from start to end."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(3.6e9)


def hour_boundaries_between(start, end) -> Column:
    """Number of hour boundaries crossed from start to end (DATE_DIFF('hour'))."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _c(start)), F.date_trunc("HOUR", _c(end)))


def days_until(as_of, ts) -> Column:
    """Calendar days from the as-of date to the date of ts (DATE_DIFF('day'))."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(_c(as_of))).cast("bigint")


def is_real_forecast(available, value, sentinels) -> Column:
    """Available and not a sentinel. NULL value -> NULL (SQL NOT IN semantics)."""
    return (_c(available) == F.lit(True)) & ~_c(value).isin(*[float(s) for s in sentinels])
