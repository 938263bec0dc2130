"""Time expressions on timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR, DAY = "INTERVAL 1 HOUR", "INTERVAL 1 DAY"


def hour_start(ts) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_end(ts) -> Column:
    """The end of the hour that holds ts; a reading on the full hour belongs to the hour that ends there."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return hour_start(ts - F.expr("INTERVAL 1 MICROSECOND")) + F.expr(HOUR)


def closed_day(ts) -> Column:
    """The day (D 00:00, D+1 00:00] that holds ts."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(ts - F.expr("INTERVAL 1 MICROSECOND"))


def hour_number(ts) -> Column:
    """Whole hours since 1970, for frames over hours."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / 3600)


def expected_hours(start, end, after=None) -> Column:
    """Full hours in [start, end), and later than `after`."""
    start = F.when(hour_start(start) == start, start).otherwise(hour_start(start) + F.expr(HOUR))
    hours = F.when(start < end, F.sequence(start, end, F.expr(HOUR))).otherwise(F.array().cast("array<timestamp_ntz>"))
    hours = F.filter(hours, lambda h: h < end)
    return hours if after is None else F.filter(hours, lambda h: h > after)


def hour_endpoints(start, end) -> Column:
    """Full hours in (start, end]."""
    first = hour_start(start) + F.expr(HOUR)
    return F.when(first <= end, F.sequence(first, end, F.expr(HOUR))).otherwise(F.array().cast("array<timestamp_ntz>"))


def local_day(ts, zone) -> Column:
    """The calendar day in a time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def covered_days(start, end) -> Column:
    """Days that lie wholly in [start, end)."""
    first = F.when(hour_midnight(start) == start, F.to_date(start)).otherwise(F.date_add(F.to_date(start), 1))
    last = F.date_sub(F.to_date(end), 1)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def hour_midnight(ts) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def days_inclusive(first, last) -> Column:
    return F.datediff(last, first) + 1


def utc_from_source(date, time) -> Column:
    """A source's date (d/m/y with two or four digits, or ISO) and time; 24:00 is the next day's start; else null."""
    iso = F.regexp_extract(date, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 0) != ""
    parts = F.when(iso, F.split(date, "-")).otherwise(F.reverse(F.split(date, "/")))
    year = F.when(F.length(F.get(parts, F.lit(0))) == 2, F.concat(F.lit("20"), F.get(parts, F.lit(0)))).otherwise(F.get(parts, F.lit(0)))
    day = F.concat_ws("-", year, F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.lpad(F.get(parts, F.lit(2)), 2, "0"))
    late = time == "24:00"
    at = F.try_to_timestamp(F.concat(day, F.lit(" "), F.when(late, F.lit("00:00")).otherwise(time)), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")
    return F.when(late, at + F.expr(DAY)).otherwise(at)


def utc_without_zone(text) -> Column:
    """A timestamp text; without a zone it is in UTC."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(zoned, text).otherwise(F.concat(text, F.lit("Z")))).cast("timestamp_ntz")
