"""Time expressions. ``now`` is always a parameter, never the clock; the session time zone is UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

HOUR_MICROS = 3_600_000_000


def instant(value: datetime | str | Column) -> Column:
    """A timestamp column from an aware datetime, an ISO text in UTC, or a column."""
    if isinstance(value, Column):
        return value
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def age_micros(anchor: Column, now: datetime | str | Column) -> Column:
    """Microseconds from ``anchor`` to ``now``."""
    return F.unix_micros(instant(now)) - F.unix_micros(anchor)


def is_too_old(anchor: Column, now: datetime | str | Column, max_age_hours: int) -> Column:
    """Strictly older than the age limit."""
    return age_micros(anchor, now) > F.lit(max_age_hours * HOUR_MICROS)


def freshness(anchor: Column, now: datetime | str | Column, max_age_hours: int) -> Column:
    """1 for a future time, 0 at the age limit and beyond, linear between."""
    age = age_micros(anchor, now)
    limit = max_age_hours * HOUR_MICROS
    return (
        F.when(age < 0, F.lit(1.0))
        .when(age >= F.lit(limit), F.lit(0.0))
        .otherwise(F.lit(1.0) - age.cast("double") / F.lit(float(limit)))
    )


def duration_ms(start: Column, finish: Column) -> Column:
    """Whole milliseconds between two times, rounded down."""
    return F.floor((F.unix_micros(finish) - F.unix_micros(start)) / F.lit(1000)).cast("bigint")


def fetch_duration_ms(start: Column, finish: Column, reported: Column) -> Column:
    """Own duration or the reported one, whichever is larger, never negative."""
    return F.greatest(F.lit(0).cast("bigint"), duration_ms(start, finish), reported.cast("bigint"))


#: Fixed offsets of the zone names that mail dates use.
ZONE_OFFSETS = {
    "": "+0000", "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def parse_feed_date(value: Column) -> Column:
    """RFC 2822 or ISO time; no zone means UTC; unreadable becomes null."""
    text = F.trim(F.regexp_replace(value, r"\A\s*([A-Za-z]{3,9},)?\s*", ""))
    shape = r"\A(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{2}|\d{4})\s+(\d{1,2}:\d{2})(:\d{2})?\s*([^()\s]*)\s*(\(.*\))?\z"
    day, month, year, clock, seconds, zone = [F.regexp_extract(text, shape, group) for group in range(1, 7)]
    century = F.when(F.length(year) == 4, "").when(year > "68", "19").otherwise("20")
    offsets = F.create_map(*[F.lit(part) for pair in ZONE_OFFSETS.items() for part in pair])
    offset = F.coalesce(F.try_element_at(offsets, F.upper(zone)), zone)
    mail = F.concat(day, F.lit(" "), month, F.lit(" "), century, year, F.lit(" "), clock,
                    F.when(seconds == "", ":00").otherwise(seconds), F.lit(" "), offset)
    iso = F.when(F.rlike(text, F.lit(r"\A\d{4}-\d{2}-\d{2}")), text)
    return F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy H:mm:ss Z")), F.try_to_timestamp(iso))


def next_fire_time(now: Column, hour: int, minute: int, zone: str) -> Column:
    """First daily ``hour:minute`` in ``zone`` that is not before ``now``, in UTC."""
    local_day = F.date_trunc("day", F.from_utc_timestamp(now, zone))
    at = F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))
    today = F.to_utc_timestamp(local_day + at, zone)
    tomorrow = F.to_utc_timestamp(local_day + F.make_dt_interval(days=F.lit(1)) + at, zone)
    return F.when(today >= now, today).otherwise(tomorrow)


def iso_utc(value: Column) -> Column:
    """ISO text with seconds and a ``Z``."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")
