"""Column expressions; everything here is a built-in Spark expression."""

from hourglass.functions.clock import (
    COMMIT_TS_PATTERN,
    HOUR_RANGE_LABELS,
    LOCAL_OFFSET_HOURS,
    api_window_text,
    date_id,
    date_text,
    format_commit_ts,
    hour_range_3h,
    hour_range_literal,
    local_day,
    local_day_bounds,
    local_day_window,
    local_hour,
    parse_commit_ts,
    to_local,
    weekday_name,
    weekday_number,
)

__all__ = [
    "COMMIT_TS_PATTERN", "HOUR_RANGE_LABELS", "LOCAL_OFFSET_HOURS", "api_window_text",
    "date_id", "date_text", "format_commit_ts", "hour_range_3h", "hour_range_literal",
    "local_day", "local_day_bounds", "local_day_window", "local_hour", "parse_commit_ts",
    "to_local", "weekday_name", "weekday_number",
]
