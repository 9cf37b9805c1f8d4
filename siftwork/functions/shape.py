"""Durations, orientation, dates and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V
from .text import as_col, rounded, strip

_DAY_MICROS = 86_400_000_000


def duration_seconds(c) -> Column:
    """ISO-8601 day/time duration to seconds; null when unreadable or zero."""
    t = strip(as_col(c))

    def part(i, unit):
        return F.coalesce(F.regexp_extract(t, V.DURATION_PATTERN, i).try_cast("bigint"), F.lit(0)) * unit

    total = part(1, 86400) + part(2, 3600) + part(3, 60) + part(4, 1)
    return F.when(t.rlike(V.DURATION_PATTERN) & (total > 0), total)


def is_vertical(w, h, max_ratio=V.MAX_VERTICAL_RATIO) -> Column:
    """Three-valued: null when a side is missing, unreadable or not positive."""
    wd, hd = (as_col(x).cast("string").try_cast("double") for x in (w, h))
    return F.when((wd > 0) & (hd > 0), F.try_divide(wd, hd) <= max_ratio)


def is_short(seconds, w, h, max_seconds=V.SHORT_MAX_SECONDS) -> Column:
    """Vertical or at most ``max_seconds`` long; null when neither can be told."""
    return F.coalesce(is_vertical(w, h), F.lit(False)) | (as_col(seconds) <= max_seconds)


_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def parse_ts(c) -> Column:
    """Tolerant ISO-8601 parse, no offset means UTC, anything else is null."""
    c = as_col(c)
    return F.when(c.rlike(_ISO), F.try_to_timestamp(c))


def whole_days(earlier, later) -> Column:
    """Whole elapsed days, floored as a calendar-free difference."""
    diff = F.unix_micros(as_col(later).cast("timestamp")) - F.unix_micros(as_col(earlier).cast("timestamp"))
    return F.floor(diff / F.lit(_DAY_MICROS))


def instant(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def age_months(ts, as_of: str) -> Column:
    return whole_days(ts, instant(as_of)) / F.lit(V.DAYS_PER_MONTH)


def settled(published, as_of: str, days=V.SETTLED_DAYS) -> Column:
    """Public long enough for its count to be read; unknown date is not settled."""
    return F.coalesce(whole_days(published, instant(as_of)) >= days, F.lit(False))


def local_day(ts, tz: str) -> Column:
    return F.to_date(F.from_utc_timestamp(as_col(ts), tz))


def qualify(age, min_age) -> Column:
    """Only a known age below a set minimum is flagged."""
    m = F.lit(None).cast("double") if min_age is None else (min_age if isinstance(min_age, Column) else F.lit(min_age))
    return F.when(as_col(age) < m, F.lit(V.NEW_ENTITY)).otherwise(F.lit(V.QUALIFIED))


def _span_days(first, last) -> Column:
    return whole_days(first, last)


def upload_frequency(n, first, last) -> Column:
    """Items per 30 days over the sampled span; same-day span gives the count, one date gives 0."""
    span = _span_days(first, last)
    return (
        F.when(as_col(n) < 2, F.lit(0.0))
        .when(span <= 0, as_col(n).cast("double"))
        .otherwise(rounded(F.try_divide(as_col(n).cast("double"), span) * 30, 2))
    )


def uploads_per_year(n, first, last) -> Column:
    """Monthly pace times twelve, null (not zero) when the sample cannot show one."""
    span = _span_days(first, last)
    return F.when((as_col(n) >= 2) & (span > 0), rounded(F.try_divide(as_col(n).cast("double"), span) * 30, 2) * 12)
