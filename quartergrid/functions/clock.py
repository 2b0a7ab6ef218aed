"""Wall-clock columns. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartergrid.config import GridWindow


def local_time(ts_utc: Column, zone: Column) -> Column:
    """UTC instant to the wall clock of ``zone``."""
    return F.from_utc_timestamp(ts_utc, zone)


def step_index(local: Column, window: GridWindow) -> Column:
    """Step holding a local time, -1 outside the closed window, null if null."""
    begin = F.lit(window.begin_text).cast("timestamp")
    end = F.lit(window.end_text).cast("timestamp")
    seconds = F.unix_seconds(local) - F.unix_seconds(begin)
    inside = F.floor(seconds / F.lit(window.step_seconds))
    return (
        F.when(local.between(begin, end), inside)
        .when(local.isNotNull(), F.lit(-1).cast("long"))
    )


def step_time(step: Column, window: GridWindow) -> Column:
    """Local time at which a step begins."""
    begin = F.unix_seconds(F.lit(window.begin_text).cast("timestamp"))
    return F.timestamp_seconds(begin + step * F.lit(window.step_seconds))


def clock_minutes(text: Column) -> Column:
    """Minutes of ``h:mm am`` text.

    ``pm`` adds twelve hours to hours below 12; ``am`` never subtracts, ``PM``
    is not recognised, and anything unreadable is midnight.
    """
    parts = F.split(text, ":")
    hour = F.get(parts, F.lit(0)).try_cast("int")
    minute = F.get(F.split(F.get(parts, F.lit(1)), " "), F.lit(0)).try_cast("int")
    shift = F.when(text.contains("pm") & (hour < 12), 720).otherwise(0)
    return F.coalesce(hour * 60 + minute + shift, F.lit(0))


def observation_time(date: Column, hour: Column) -> Column:
    """Local time of an observation given as ``2018-06-01`` and ``1:53 PM``."""
    return F.try_to_timestamp(F.concat(date, F.lit(" "), hour), F.lit("yyyy-M-d h:m a"))


def weekday_flag(dow: Column) -> Column:
    """1 for Monday (0) to Friday (4), else 0."""
    return F.when(dow < 5, 1).otherwise(0)


def hour_class(hod: Column) -> Column:
    """Part of the day: morning 0, midday 1, afternoon 2, evening 3, night 4."""
    return (
        F.when(hod.between(6, 9), 0)
        .when(hod.between(10, 14), 1)
        .when(hod.between(15, 17), 2)
        .when(hod.between(18, 21), 3)
        .otherwise(4)
    )
