"""Date and time column functions. They take ``timestamp`` and ``timestamp_ntz`` alike."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROSECOND = timedelta(microseconds=1)


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970, without a detour through the session zone for zone-free times."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    return F.unix_micros(F.col(ts))


def time_slice(df: DataFrame, ts: str, width: timedelta) -> Column:
    """Start, in microseconds since 1970, of the ``width``-wide slice of the time line that holds ``ts``."""
    instant = epoch_micros(df, ts)
    return instant - F.pmod(instant, F.lit(max(width // MICROSECOND, 1)))


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def day_hour(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH")


def minute(ts: Column) -> Column:
    return F.date_format(ts, "mm")


def parse_date(c: Column, strict: bool = False) -> Column:
    """ISO date text as a date: null when bad, or a failing query if ``strict``."""
    return F.to_date(c, "yyyy-MM-dd") if strict else F.try_to_date(c, "yyyy-MM-dd")


def parse_second(c: Column) -> Column:
    """Log time ``yyyy-MM-dd HH:mm:ss`` as a zone-free timestamp, null when bad."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def is_weekday(d: Column) -> Column:
    """1 from Monday to Friday, 0 on weekends."""
    return F.dayofweek(d).between(2, 6).cast("int")


def known_zone(zone: Column) -> Column:
    """The zone id if it is one, else null."""
    probe = F.try_to_timestamp(F.concat(F.lit("2020-01-01 00:00:00 "), zone), F.lit("yyyy-MM-dd HH:mm:ss VV"))
    return F.when(probe.isNotNull(), zone)


def local_time(ts: Column, zone: Column, stored_zone: Column) -> Column:
    """Wall clock in ``zone`` of a time stored in ``stored_zone``; as stored when the zone is unknown."""
    stored = ts.cast("timestamp_ntz")
    return F.when(zone.isNotNull(), F.convert_timezone(stored_zone, zone, stored)).otherwise(stored)
