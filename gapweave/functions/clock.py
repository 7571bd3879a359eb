"""Date and time expressions.

Clock values are ``TIMESTAMP_NTZ``: UTC in ``time_utc``, station time in
``time_local``.  Everything is built from calendar parts, so no result depends
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Station offset from UTC in hours (no daylight saving), and the
# origin that gridded archives count their hours from.
LOCAL_OFFSET_HOURS = -3
GRID_EPOCH = "1900-01-01 00:00:00"

# Spellings of clock times in sensor logs (hours and minutes,
# seconds or not) and of the digits that lead an exported record id.
CLOCK_SPELLING = r"^\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*$"
STAMP_SPELLING = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})"


def add(unit: str, amount: Column | int, time: Column) -> Column:
    return F.timestamp_add(unit, F.lit(amount) if isinstance(amount, int) else amount, time)


def midnight(time: Column) -> Column:
    return F.to_date(time).cast("timestamp_ntz")


def floor_time(time: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide slot holding ``time`` (slots divide a day)."""
    if 1440 % minutes:
        raise ValueError("slot width must divide a day")
    if minutes == 1440:
        return midnight(time)
    of_day = F.hour(time) * 60 + F.minute(time)
    return add("MINUTE", of_day - of_day % minutes, midnight(time))


def round_time(time: Column, minutes: int) -> Column:
    """Nearest multiple of ``minutes``; a tie goes to the later one."""
    return floor_time(add("SECOND", minutes * 30, time), minutes)


def to_local(time_utc: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Station clock from UTC with one fixed shift, in summer and winter alike."""
    return add("HOUR", offset_hours, time_utc)


def relabel(time: Column) -> Column:
    """Keep the clock reading, drop the zone label."""
    return time.cast("timestamp_ntz")


def parts(time: Column) -> dict[str, Column]:
    return {
        "year": F.year(time),
        "month": F.month(time),
        "day": F.dayofmonth(time),
        "hour": F.hour(time),
        "minute": F.minute(time),
        "yday": F.dayofyear(time),
    }


def from_parts(year: Column, month: Column, day: Column, hour: Column, minute: Column | None = None,
               second: Column | None = None) -> Column:
    """Timestamp from parts; an impossible date gives NULL."""
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        year.cast("int"), month.cast("int"), day.cast("int"), hour.cast("int"),
        (zero if minute is None else minute).cast("int"),
        (zero if second is None else second).cast("decimal(16,6)"),
    )


def date_from_parts(year: Column, month: Column, day: Column | None = None) -> Column:
    """Date from parts (first of the month without ``day``); bad parts give NULL."""
    day = F.lit(1) if day is None else day
    return F.to_date(from_parts(year, month, day, F.lit(0)))


def full_year(year: Column, pivot: int = 2000) -> Column:
    """Two-digit years belong to this century."""
    return F.when(year < pivot, year + pivot).otherwise(year)


def _piece(text: Column, spelling: str, group: int) -> Column:
    """Number in a group of ``spelling``; NULL where the text does not fit or the group is empty."""
    return F.regexp_extract(text, spelling, group).try_cast("int")


def from_clock_text(day: Column, clock: Column) -> Column:
    """Timestamp from a date and a clock text such as ``7:30`` or ``07:30:05``; NULL if unreadable."""
    second = F.coalesce(_piece(clock, CLOCK_SPELLING, 3), F.lit(0))
    return from_parts(F.year(day), F.month(day), F.dayofmonth(day),
                      _piece(clock, CLOCK_SPELLING, 1), _piece(clock, CLOCK_SPELLING, 2), second)


def from_stamp_prefix(text: Column) -> Column:
    """Timestamp from the fourteen digits that lead an exported record id."""
    return from_parts(*[_piece(text, STAMP_SPELLING, i) for i in range(1, 7)])


def from_grid_hours(hours: Column, lead_hours: Column | None = None, epoch: str = GRID_EPOCH) -> Column:
    """Timestamp from hours since the archive origin, plus an optional (fractional) lead."""
    seconds = F.round(hours.cast("double") * 3600)
    if lead_hours is not None:
        seconds = seconds + F.round(lead_hours.cast("double") * 3600)
    return add("SECOND", seconds.cast("bigint"), F.lit(epoch).cast("timestamp_ntz"))


def epoch_seconds(time: Column) -> Column:
    """Seconds since 1970 on the value's own clock."""
    return (F.unix_date(F.to_date(time)).cast("bigint") * 86400
            + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time))


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    return epoch_seconds(later) - epoch_seconds(earlier)


def decimal_year(time: Column) -> Column:
    """Year plus the elapsed share of it."""
    start = F.make_date(F.year(time), F.lit(1), F.lit(1))
    end = F.make_date(F.year(time) + 1, F.lit(1), F.lit(1))
    into = epoch_seconds(time) - F.unix_date(start).cast("bigint") * 86400
    return F.year(time) + into / (F.datediff(end, start) * 86400)


def year_month(time: Column) -> Column:
    """Block label such as ``2011_7``."""
    return F.concat_ws("_", F.year(time).cast("string"), F.month(time).cast("string"))
