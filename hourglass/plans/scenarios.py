"""Inputs of the registered queries, all derived from the driver's ``events``.

The email mapping per use follows the data's shape: ``fine`` (one committer
per user) for rankings and streaks, ``coarse`` (five committers) for the heat
map, ``dirty`` (NULL emails, several ids per key) for merges and checks.

Merge scenario.  All dates come from the data: the run covers three business
days from the middle day of the table on.  The target holds what an earlier run
left, for all days: the commits without those whose ``event_id`` is divisible
by 3, and nothing on the run's last day.  The source is the commits without
those divisible by 5, and nothing on the run's middle day.  So the run meets
keys in both tables (with other counts and ids), keys in the target only
(non-NULL ones too), keys in the source only, a day that disappears, a day that
is new, and many days outside the run that stay.  The target's d_date rows of
even days carry another weekday text, which a matched row must keep.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.clock import local_day
from hourglass.operators.dims import d_date_rows
from hourglass.operators.facts import hourly_fact
from hourglass.operators.merge import combine_duplicate_keys
from hourglass.operators.normalize import normalize_commits
from hourglass.sources.events import events_as_bronze, read_events

RUN_DAYS = 3


def bounds(spark: SparkSession, sf_dir: str) -> tuple[_dt.date, _dt.date]:
    """First and last business day of the table (one row)."""
    day = local_day(F.col("ts"))
    r = read_events(spark, sf_dir).agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    return r["a"], r["b"]


def run_days_of(spark: SparkSession, sf_dir: str) -> list[_dt.date]:
    """The run's three days, the first of them the middle day of the table."""
    first, last = bounds(spark, sf_dir)
    middle = first + _dt.timedelta(days=(last - first).days // 2)
    return [middle + _dt.timedelta(days=k) for k in range(RUN_DAYS)]


def bronze(spark: SparkSession, sf_dir: str, email: str) -> DataFrame:
    return events_as_bronze(read_events(spark, sf_dir), email)


def staging(spark: SparkSession, sf_dir: str, email: str) -> DataFrame:
    return normalize_commits(bronze(spark, sf_dir, email))


def fact(spark: SparkSession, sf_dir: str, email: str) -> DataFrame:
    return hourly_fact(normalize_commits(bronze(spark, sf_dir, email), carry_time=True))


def d_date(spark: SparkSession, sf_dir: str, email: str) -> DataFrame:
    return d_date_rows(staging(spark, sf_dir, email))


def observed_days(events: DataFrame) -> DataFrame:
    """The different business days of events, without turning them into commits."""
    return events.select(local_day(F.col("ts")).alias("dt")).distinct()


def _without(spark: SparkSession, sf_dir: str, divisor: int, day: _dt.date) -> DataFrame:
    """``dirty`` commits with local times, but for some ids and one day."""
    sha = F.col("sha").cast("bigint")
    rows = normalize_commits(bronze(spark, sf_dir, "dirty").where(sha % divisor != 0), carry_time=True)
    return rows.where(F.col("dt") != F.lit(day))


# ``days``: the run's days (``run_days_of``), found once per query.
def target_fact(spark: SparkSession, sf_dir: str, days: list[_dt.date]) -> DataFrame:
    return combine_duplicate_keys(hourly_fact(_without(spark, sf_dir, 3, days[2])))


def target_d_date(spark: SparkSession, sf_dir: str, days: list[_dt.date]) -> DataFrame:
    """Of the same commits; only their days are needed."""
    rows = observed_days(read_events(spark, sf_dir).where(F.col("event_id") % 3 != 0)).where(F.col("dt") != F.lit(days[2]))
    rows = d_date_rows(rows)
    other = F.concat(F.lit("old "), F.col("weekday"))
    return rows.withColumn("weekday", F.when(F.col("d_date_id") % 2 == 0, other).otherwise(F.col("weekday")))


def source_staging(spark: SparkSession, sf_dir: str, days: list[_dt.date]) -> DataFrame:
    return _without(spark, sf_dir, 5, days[1])
