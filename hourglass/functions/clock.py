"""Column expressions for commit times, the local business day and date keys.

All arithmetic is on TIMESTAMP_NTZ values, so results do not depend on the
session time zone or on daylight-saving rules: business time is a fixed offset
from UTC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
#   commit timestamp text:  %Y-%m-%dT%H:%M:%SZ   (UTC)
#   business time offset:   GMT+7, no daylight saving
#   heat-map hour ranges:   01-03 04-06 07-09 10-12 13-15 16-18 19-21 22-00
# ---------------------------------------------------------------------------
COMMIT_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
LOCAL_OFFSET_HOURS = 7
HOUR_RANGE_LABELS = ("01-03", "04-06", "07-09", "10-12", "13-15", "16-18", "19-21", "22-00")

# Text accepted by Python's strptime with the pattern above, which is what the
# original transform applies: the field grammar of %Y %m %d %H %M %S (fields may
# be unpadded, a day may be space-padded, seconds 60-61 match but are then
# rejected as a date), letters compared case-insensitively, years 0001-9999.
_COMMIT_TS_SHAPE = (r"^(?!0000)[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
                    r"T(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):(6[01]|[0-5][0-9]|[0-9])Z$")


def parse_commit_ts(text: Column) -> Column:
    """UTC commit time text -> TIMESTAMP_NTZ, NULL when it is not a valid time.

    One regular expression keeps the (upper-cased) text when its shape is
    right and gives '' otherwise; without the day's padding space and the
    trailing Z it is cast to TIMESTAMP_NTZ, which needs no time zone and
    yields NULL for '' and for impossible dates (Feb 30, second 60).  The input
    is referenced once, so an expensive upstream expression is not evaluated
    several times.  Never raises, whatever the ANSI setting; strict callers
    turn NULL into an error themselves (see ``operators.normalize``).
    """
    shaped = F.regexp_extract(F.upper(text), _COMMIT_TS_SHAPE, 0)
    return F.translate(shaped, " Z", "").try_cast("timestamp_ntz")


def format_commit_ts(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> UTC text ``YYYY-MM-DDTHH:MM:SSZ`` (sub-seconds dropped).

    Built from the wall-clock string so no time zone is consulted.
    """
    return F.concat(F.translate(F.substring(ts.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def to_local(ts_utc: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """UTC wall clock -> business wall clock."""
    return F.timestamp_add("HOUR", F.lit(int(offset_hours)), ts_utc)


def local_day(ts_utc: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """The business day a UTC instant falls on."""
    return to_local(ts_utc, offset_hours).cast("date")


def local_hour(ts_utc: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Hour of the business day, 0-23, as BIGINT."""
    return F.hour(to_local(ts_utc, offset_hours)).cast("bigint")


def local_day_bounds(day: _dt.date, offset_hours: int = LOCAL_OFFSET_HOURS
                     ) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open UTC interval [since, until) covering business day ``day``.

    The extractor asks for (day-1) 17:00:00Z .. day 16:59:59Z inclusive, which
    at second precision is the same set as this half-open interval.
    """
    start = _dt.datetime.combine(day, _dt.time()) - _dt.timedelta(hours=offset_hours)
    return start, start + _dt.timedelta(days=1)


def local_day_window(ts_utc: Column, first_day: _dt.date, last_day: _dt.date,
                     offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Predicate: UTC timestamp lies in business days first_day..last_day.

    The bare column is compared with literals on both sides, so Parquet
    min/max statistics prune row groups (the predicate shows up in
    PushedFilters); ``local_day(ts) BETWEEN ..`` would not push down.
    """
    since, _ = local_day_bounds(first_day, offset_hours)
    _, until = local_day_bounds(last_day, offset_hours)
    return (ts_utc >= F.lit(since).cast("timestamp_ntz")) & (ts_utc < F.lit(until).cast("timestamp_ntz"))


def api_window_text(day: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> tuple[Column, Column]:
    """The extractor's inclusive (since, until) request bounds for a day column."""
    start = F.timestamp_add("HOUR", F.lit(-int(offset_hours)), day.cast("timestamp_ntz"))
    end = F.timestamp_add("SECOND", F.lit(24 * 3600 - 1), start)
    return format_commit_ts(start), format_commit_ts(end)


def date_id(day: Column) -> Column:
    """yyyymmdd as BIGINT, computed without string work."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def date_text(day: Column) -> Column:
    """yyyy-mm-dd."""
    return F.date_format(day, "yyyy-MM-dd")


def weekday_name(day: Column) -> Column:
    """Full English weekday name, e.g. Monday."""
    return F.date_format(day, "EEEE")


def weekday_number(day: Column) -> Column:
    """Monday=1 .. Sunday=7 as BIGINT."""
    return (F.weekday(day) + 1).cast("bigint")


def hour_range_3h(hour: Column) -> Column:
    """Intended three-hour label: 1-3 -> 01-03, ..., 19-21 -> 19-21, 22/23/0 -> 22-00."""
    first = F.floor((hour - 1) / 3) * 3 + 1
    return (F.when((hour == 0) | (hour >= 22), F.lit("22-00"))
            .otherwise(F.format_string("%02d-%02d", first.cast("int"), (first + 2).cast("int"))))


def hour_range_literal(hour: Column) -> Column:
    """Label exactly as the original DDL computes it.

    Its ``/`` is floating-point division, so ``((h-1)/3)*3+1`` is just ``h``
    and the label is ``hh-(hh+2)`` (hour 0 -> 22-00); float-to-integer casts
    round to nearest, as in the original engine.
    """
    lo = F.round(((hour - 1) / 3.0) * 3 + 1).cast("int")
    hi = F.round(((hour - 1) / 3.0) * 3 + 3).cast("int")
    return F.format_string("%02d-%02d",
                           F.when(hour == 0, F.lit(22)).otherwise(lo),
                           F.when(hour == 0, F.lit(0)).otherwise(hi))
