"""Dates: calendar parts, boundary-counting differences, ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAY_HOURS = (9, 23)
WEEKEND_HOURS = (9, 18)
TEXT_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def week_number(ts: Column) -> Column:
    """Week counted from 1 January, weeks starting on Monday (not the ISO week)."""
    january_first = F.trunc(ts.cast("date"), "YEAR")
    return F.floor((F.dayofyear(ts) - 1 + F.weekday(january_first)) / 7) + 1


def working_hour(ts: Column) -> Column:
    """'Hour' inside opening hours, else 'Off-Hour'; both ends inclusive."""
    weekend = F.weekday(ts) >= 5
    open_now = F.when(weekend, F.hour(ts).between(*WEEKEND_HOURS)).otherwise(F.hour(ts).between(*WEEKDAY_HOURS))
    return F.when(open_now, F.lit("Hour")).otherwise(F.lit("Off-Hour"))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "received_date": ts.cast("date"),
        "received_month": F.month(ts),
        "received_year": F.year(ts),
        "week_number": week_number(ts),
        "received_hour": F.hour(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "working_hour": working_hour(ts),
    }


def epoch_second(ts: Column) -> Column:
    """Whole seconds since the epoch; both timestamp types are read as UTC wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, F.date_trunc("SECOND", ts).cast("timestamp_ntz"))


def seconds_crossed(start: Column, end: Column) -> Column:
    """How many second boundaries lie between two times."""
    return epoch_second(end) - epoch_second(start)


def minutes_crossed(start: Column, end: Column) -> Column:
    """How many minute boundaries lie between two times: 1 from 00:00:59 to 00:01:00."""
    minute = lambda ts: F.floor(epoch_second(ts) / 60)
    return minute(end) - minute(start)


def days_crossed(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def days_between(start: Column, end: Column) -> Column:
    """Elapsed time in fractional days."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(86_400_000_000.0)


def age_years(dob: Column, on: Column) -> Column:
    """Whole years as days over 365; an age above 1000 comes from a wrong century."""
    years = (F.datediff(on.cast("date"), dob.cast("date")) / 365).cast("int")
    return F.when(years > 1000, years - 1000).otherwise(years)


def dob_from_parts(month: Column, day: Column, year: Column) -> Column:
    """'m/d/y'; NULL as soon as one part is."""
    return F.concat(month, F.lit("/"), day, F.lit("/"), year)


def parse_text_date(text: Column) -> Column:
    """Timestamp from the text forms that occur in vendor files; NULL when none fits."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(form)) for form in TEXT_FORMATS])


def cycled(date_due: Column, as_of: Column, days: int = 7) -> Column:
    return F.when(days_crossed(date_due, as_of) > days, 1).otherwise(0)
