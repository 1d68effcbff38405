"""Date and hour-of-day dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.clock import (
    date_id,
    date_text,
    hour_range_3h,
    hour_range_literal,
    weekday_name,
    weekday_number,
)


def d_date_rows(days: DataFrame) -> DataFrame:
    """One d_date row per distinct ``dt`` of the input (observed days only).

    The distinct runs first (partial aggregation leaves at most one row per
    day per task), so the formatting touches a handful of rows.
    """
    d = days.select("dt").distinct()
    return d.select(
        date_id(F.col("dt")).alias("d_date_id"),
        date_text(F.col("dt")).alias("date_str"),
        weekday_name(F.col("dt")).alias("weekday"),
        weekday_number(F.col("dt")).alias("weekday_number"),
        F.col("dt"),
    )


def d_time(spark: SparkSession, variant: str = "3h") -> DataFrame:
    """The 24-row hour dimension.

    ``3h`` (default) labels eight three-hour ranges as documented:
    1-3 -> 01-03 ... 19-21 -> 19-21 and 22, 23, 0 -> 22-00.  ``literal``
    reproduces the original DDL text, whose float division yields
    ``hh-(hh+2)`` labels (see ``functions.clock.hour_range_literal``).
    """
    hour = F.col("id")
    label = {"3h": hour_range_3h, "literal": hour_range_literal}[variant](hour)
    return spark.range(24, numPartitions=1).select(
        hour.cast("bigint").alias("d_time_id"), label.alias("hour_range_str"))
