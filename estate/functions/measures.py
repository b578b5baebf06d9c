"""Column expressions over sizes, ages and durations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from estate.functions import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp(value: datetime | str | Column) -> Column:
    """A point in time given as a parameter, without time zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with their fraction; the session time zone plays no part."""
    return (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")


def instant(wall: Column) -> Column:
    """A time without zone read as UTC, for operators that need an instant."""
    return F.timestamp_micros(F.round(seconds_between(wall, timestamp("1970-01-01")) * 1_000_000).cast("bigint"))


def wall(at: Column) -> Column:
    """The time without zone of an instant, in UTC."""
    seconds = (F.unix_micros(at) / 1_000_000).cast("decimal(18,6)")
    return timestamp("1970-01-01") + F.make_dt_interval(secs=seconds)


def floor_time(ts: Column, seconds: int) -> Column:
    """Start of the time bucket of the given width, counted from midnight."""
    start = F.floor(seconds_between(ts, timestamp("1970-01-01")) / seconds) * seconds
    return timestamp("1970-01-01") + F.make_dt_interval(secs=start)


def mb(size: Column | str) -> Column:
    return _col(size) / F.lit(rules.MIB)


def gb(size: Column | str) -> Column:
    return _col(size) / F.lit(rules.GIB)


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``scale * part / whole``, 0 for an empty whole."""
    return F.when(whole > 0, F.lit(scale) * part / whole).otherwise(F.lit(0.0))


def size_bucket(size: Column | str) -> Column:
    s = _col(size)
    return (
        F.when(s.isNull() | (s <= 0), "unknown")
        .when(s < rules.SMALL_BELOW, "small")
        .when(s < rules.MEDIUM_BELOW, "medium")
        .otherwise("large")
    )


def age_bucket(ts: Column | str, as_of: datetime | str | Column) -> Column:
    """Age class by elapsed seconds; the future counts as recent, no time as older."""
    age = seconds_between(timestamp(as_of), _col(ts))
    (limit, label), *rest = rules.AGE_CLASSES
    bucket = F.when(age < limit, label)
    for limit, label in rest:
        bucket = bucket.when(age < limit, label)
    return bucket.otherwise(rules.AGE_OTHERWISE)


def human_size(size: Column | str) -> Column:
    """Largest 1024-based unit not above the size, two decimals; ``0 B`` for nothing."""
    s = _col(size)
    label = F.when(s == 0, F.lit("0 B"))
    for power in range(len(rules.SIZE_UNITS) - 1, 0, -1):
        label = label.when(s >= F.lit(1024**power), _scaled(s, power))
    return label.when(s.isNotNull(), _scaled(s, 0))


def _scaled(s: Column, power: int) -> Column:
    value = F.round(s.cast("double") / F.lit(float(1024**power)), 2)
    return F.concat(value.cast("string"), F.lit(" " + rules.SIZE_UNITS[power]))


def eta_label(hours: Column | str) -> Column:
    h = _col(hours)
    return (
        F.when(h < 1, F.format_string("%.0f minutes", h * 60))
        .when(h < 24, F.format_string("%.1f hours", h))
        .when(h >= 24, F.format_string("%.1f days", h / 24))
    )
