"""Longest streaks kept up to date month by month.

A committer's days of one stretch of months have a summary: how long the run
at its beginning is, the run at its end, the best run, and whether every day
is active.  Summaries of neighbouring stretches combine to that of both, and
combining is associative, so months combine to years and years to all time in
a tree; a stretch with a gap of months before it does not carry a run over.

The summaries lie in folders by month (``dt`` = its first day).  After a
re-run of some days only their months are summarised again, from those months'
days of the fact; the answer then reads summaries only, a row per committer
and active month however many commits there were.

Rows: a month's summary is a window over one committer's days of one month; the
combining groups hold at most twelve months, and a committer's years.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.operators.streaks import committers_at_best
from hourglass.sources.daystore import DayWrite, existing_days, read_days, replace_days
from hourglass.sources.schemas import STREAK_MONTH

_FIELDS = ("first_month", "last_month", "head", "tail", "best", "whole")


def month_bounds(first: _dt.date, last: _dt.date) -> tuple[_dt.date, _dt.date]:
    """The first day of first's month and the last day of last's."""
    after = (last.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return first.replace(day=1), after - _dt.timedelta(days=1)


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def summarise_months(fact: DataFrame) -> DataFrame:
    """committer_email, month summary and ``dt`` (the month's first day), from fact rows of whole months."""
    days = fact.select("committer_email", "dt").distinct().withColumn("month", F.trunc("dt", "month"))
    order = Window.partitionBy("committer_email", "month").orderBy("dt")
    days = days.withColumn("island", F.date_sub("dt", F.row_number().over(order)))
    runs = days.groupBy("committer_email", "month", "island").agg(F.min("dt").alias("from"), F.max("dt").alias("to"), F.count(F.lit(1)).alias("n"))
    at = lambda edge: F.coalesce(F.max(F.when(edge, F.col("n"))), F.lit(0))
    head, tail = at(F.col("from") == F.col("month")), at(F.col("to") == F.last_day("month"))
    found = runs.groupBy("committer_email", "month").agg(head.alias("head"), tail.alias("tail"), F.max("n").alias("best"))
    number = month_number(F.col("month"))
    return found.select("committer_email", number.alias("first_month"), number.alias("last_month"), "head", "tail", "best",
                        (F.col("best") == F.dayofmonth(F.last_day("month"))).alias("whole"), F.col("month").alias("dt"))


def combined(a: Column, b: Column) -> Column:
    """The summary of two stretches, a before b."""
    meet = a["last_month"] + 1 == b["first_month"]
    over = F.when(meet, a["tail"] + b["head"]).otherwise(0)
    return F.struct(a["first_month"].alias("first_month"), b["last_month"].alias("last_month"),
                    (a["head"] + F.when(meet & a["whole"], b["head"]).otherwise(0)).alias("head"),
                    (b["tail"] + F.when(meet & b["whole"], a["tail"]).otherwise(0)).alias("tail"),
                    F.greatest(a["best"], b["best"], over).alias("best"), (meet & a["whole"] & b["whole"]).alias("whole"))


def _joined(rows: DataFrame, *keys: Column) -> DataFrame:
    """One summary per group: its summaries, by time, folded together."""
    found = rows.groupBy("committer_email", *keys).agg(F.sort_array(F.collect_list(F.struct(*_FIELDS))).alias("parts"))
    rest = F.slice("parts", F.lit(2), F.size("parts"))
    return found.select("committer_email", F.aggregate(rest, F.get("parts", F.lit(0)), combined).alias("s")).select("committer_email", "s.*")


def streak_summaries(months: DataFrame) -> DataFrame:
    """One summary per committer over all their months: months to years, years to all time."""
    return _joined(_joined(months, F.floor(F.col("first_month") / 12).alias("year")))


def longest_streak_of_months(months: DataFrame) -> DataFrame:
    """Committer(s) with the longest streak: (committer_email, longest_streak)."""
    return committers_at_best(streak_summaries(months).select("committer_email", F.col("best").alias("longest_streak")))


class StreakMonths:
    """Summaries below ``root`` of a fact whose days are read by ``fact_days(first, last)``."""

    def __init__(self, spark, root: str, fact_days):
        self.spark, self.root, self.fact_days = spark, root, fact_days

    def update(self, first: _dt.date, last: _dt.date) -> DayWrite:
        """Summarise again the months that days first..last lie in; months without days left are removed."""
        first, last = month_bounds(first, last)
        return replace_days(summarise_months(self.fact_days(first, last)), self.root, "parquet", first, last)

    def months(self) -> list[_dt.date]:
        return list(existing_days(self.spark, self.root))

    def longest_streak(self) -> DataFrame:
        return longest_streak_of_months(read_days(self.spark.read, self.spark, self.root, "parquet", STREAK_MONTH))
