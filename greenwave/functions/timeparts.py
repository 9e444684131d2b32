"""Calendar expressions over local wall-clock (``timestamp_ntz``) columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WEEK_ORIGIN = "2016-12-25"  # a Sunday; week 0 starts here
TUE, WED, THU = 3, 4, 5  # dayofweek numbering, 1 = Sunday
AM_PEAK_HOURS = (6, 7, 8, 9)
PM_PEAK_HOURS = (15, 16, 17, 18, 19)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c) -> Column:
    return col(c).cast("timestamp_ntz")


def day_interval(days=0, hours=0, minutes=0, seconds=0) -> Column:
    part = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.make_dt_interval(part(days), part(hours), part(minutes), part(seconds))


def floor_hour(ts) -> Column:
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def floor_minutes(ts, minutes: int) -> Column:
    """Start of the ``minutes``-wide bucket; ``minutes`` must divide an hour, or be whole hours that divide a day."""
    if minutes <= 0 or (60 % minutes and (minutes % 60 or 1440 % minutes)):
        raise ValueError(f"{minutes} minutes neither divide an hour nor are hours that divide a day")
    if minutes % 60 == 0:
        hours = minutes // 60
        back = F.hour(col(ts)) % hours
        return (floor_hour(ts) - day_interval(hours=back)).cast("timestamp_ntz")
    step = (F.floor(F.minute(col(ts)) / minutes) * minutes).cast("int")
    return (floor_hour(ts) + day_interval(minutes=step)).cast("timestamp_ntz")


UNIT_MINUTES = {"1 hour": 60, "hour": 60, "15 min": 15, "15 minutes": 15}  # fixed spellings


def floor_period(ts, unit: str) -> Column:
    """Bucket start for '1 hour', '15 min' or any '<n> min'."""
    minutes = UNIT_MINUTES.get(unit) or int(unit.split()[0])
    return floor_minutes(ts, minutes)


def day(ts) -> Column:
    return col(ts).cast("date")


def week_index(d) -> Column:
    """Whole weeks since the week origin, truncated toward zero."""
    return (F.datediff(col(d).cast("date"), F.lit(WEEK_ORIGIN).cast("date")) / 7).cast("int")


def dow(d) -> Column:
    return F.dayofweek(col(d))


def midweek(d) -> Column:
    return dow(d).isin(TUE, WED, THU)


def tuesday_of_week(week, first_date) -> Column:
    """The Tuesday standing for a week, never before the first date in the data."""
    days = (col(week) * 7 + 2).cast("int")
    return F.greatest(first_date, F.date_add(F.lit(WEEK_ORIGIN).cast("date"), days))


def nearest_tuesday(d) -> Column:
    """The Tuesday of the Sunday-based week that holds the date."""
    return F.date_add(col(d).cast("date"), (F.lit(3) - dow(d)).cast("int"))


def last_monday(d) -> Column:
    """The Monday on or before the date."""
    return F.date_sub(F.next_day(col(d).cast("date"), "Mon"), 7)


def month_start(d) -> Column:
    return F.trunc(col(d).cast("date"), "month")


def month_hour(ts) -> Column:
    """The same time of day on the first of the month."""
    return (col(ts) - day_interval(days=(F.dayofmonth(col(ts)) - 1))).cast("timestamp_ntz")


def january_hour(ts) -> Column:
    """The same time of day on 1 January of the year."""
    months = (F.month(col(ts)) - 1).cast("int")
    return (month_hour(ts) - F.make_ym_interval(F.lit(0), months)).cast("timestamp_ntz")


def on_date(ts, d) -> Column:
    """Move a timestamp's time of day to another date."""
    shift = F.datediff(col(d).cast("date"), col(ts).cast("date"))
    return (col(ts) + day_interval(days=shift)).cast("timestamp_ntz")


def is_peak(ts, am=AM_PEAK_HOURS, pm=PM_PEAK_HOURS) -> Column:
    return F.hour(col(ts)).isin(*am, *pm)


def quarter_label(d) -> Column:
    """'YYYY.Q' by calendar quarter."""
    return F.concat_ws(".", F.year(col(d)).cast("string"), F.quarter(col(d)).cast("string"))


def fiscal_quarter(d, first_month: int = 7) -> Column:
    """'YYYY.Q' for a fiscal year that starts in ``first_month`` and is named after its last year."""
    return quarter_label(F.add_months(col(d).cast("date"), (13 - first_month) % 12))


def quarter_end(d) -> Column:
    return F.last_day(F.add_months(F.trunc(col(d).cast("date"), "quarter"), 2))


def micros_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", ntz(start), ntz(end))


def seconds_between(start, end) -> Column:
    return micros_between(start, end) / F.lit(1e6)


def add_seconds(ts, seconds) -> Column:
    """Shift a timestamp by a (possibly fractional) number of seconds."""
    micros = F.round(col(seconds) * 1e6).cast("bigint") if not isinstance(seconds, (int, float)) else F.lit(
        int(round(seconds * 1e6)))
    return F.timestamp_add("MICROSECOND", micros, ntz(ts)).cast("timestamp_ntz")


def local_time(ts, zone: str, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of a wall-clock time in ``source_zone``."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ntz(ts))
