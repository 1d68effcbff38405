"""Weekday x hour-range heat map of commit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.clock import HOUR_RANGE_LABELS


DIMENSION_ROWS = 100_000


def counted(dimension: DataFrame) -> DataFrame:
    """A dimension to broadcast, if its rows are few."""
    few = dimension.limit(DIMENSION_ROWS + 1).count() <= DIMENSION_ROWS
    return F.broadcast(dimension) if few else dimension


def fact_enriched(fact: DataFrame, d_date: DataFrame, d_time: DataFrame) -> DataFrame:
    """Fact LEFT JOIN d_date ON d_date_id LEFT JOIN d_time ON d_time_id.

    d_date should hold one row per calendar day and d_time holds 24, but
    nothing enforces it, and Spark's estimate of a derived d_date may be that
    of all the rows it comes from: so both are counted, sent to the fact if
    they have at most ``DIMENSION_ROWS`` rows, and left to Spark otherwise.
    """
    dd = counted(d_date.select("d_date_id", "weekday", "weekday_number"))
    dt_ = counted(d_time.select("d_time_id", "hour_range_str"))
    return (fact.select("d_date_id", "d_time_id", "committer_email", "commit_count", "dt")
            .join(dd, "d_date_id", "left")
            .join(dt_, "d_time_id", "left")
            .select("d_date_id", "d_time_id", "committer_email", "commit_count", "dt",
                    "weekday", "weekday_number", "hour_range_str"))


def heatmap(fact: DataFrame, d_date: DataFrame, d_time: DataFrame,
            distinct_first: bool = False,
            labels: tuple[str, ...] = HOUR_RANGE_LABELS,
            dates: Column | None = None) -> DataFrame:
    """One row per weekday, one BIGINT column per hour-range label.

    The fact meets the dimensions as sums per date and hour, so at most 24
    rows a day are joined, however large it is.  ``distinct_first`` reproduces the original query, which applies SELECT
    DISTINCT to (weekday, weekday_number, label, commit_count) before summing,
    so equal counts in one cell collapse into one.  A label that is not among
    ``labels`` is not counted; a missing dimension row gives a NULL weekday
    row, sorted first.  Each cell is SUM(CASE WHEN label = x THEN count ELSE 0
    END): one hash aggregate, partial on the map side.

    ``dates`` is a condition on d_date's columns (a weekday, a month): only
    the chosen dates count, and a fact row without a date row does not.  The
    join then carries ``dt`` as well, so that Spark prunes the fact's day
    folders by the chosen dates before it reads them.
    """
    by = ["d_date_id", "d_time_id"] if dates is None else ["dt", "d_date_id", "d_time_id"]
    keys = fact.select(*by, "commit_count")
    # The form that drops equal rows needs every different count; the other one only their sum.
    keys = keys.distinct() if distinct_first else keys.groupBy(*by).agg(F.sum("commit_count").alias("commit_count"))
    if dates is None:
        rows = keys.join(d_date.select("d_date_id", "weekday", "weekday_number"), "d_date_id", "left")
    else:
        # Days are pruned by the very rows that are broadcast (counted first).  The columns stay in the
        # table's order: for another one Spark does not see that both are the same, and reads every day.
        used = ("dt", "d_date_id", "weekday", "weekday_number")
        chosen = counted(d_date.where(dates).select(*(c for c in d_date.columns if c in used)))
        rows = keys.join(chosen, ["dt", "d_date_id"])
    rows = (rows.join(d_time.select("d_time_id", "hour_range_str"), "d_time_id", "left")
            .select("weekday", "weekday_number", "hour_range_str", "commit_count"))
    if distinct_first:
        rows = rows.distinct()
    cells = [F.sum(F.when(F.col("hour_range_str") == F.lit(x), F.col("commit_count"))
                   .otherwise(F.lit(0))).cast("bigint").alias(x) for x in labels]
    return (rows.groupBy("weekday", "weekday_number").agg(*cells)
            .orderBy(F.col("weekday_number").asc_nulls_first())
            .select("weekday", *labels))
