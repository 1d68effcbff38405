"""Longest run of consecutive commit days per committer.

The stages of the analyst query are separate functions: daily activity ->
streak boundaries (LAG) -> streak groups (running SUM) -> streak lengths.  The
answer itself needs one window only: on a run of consecutive days, the day less
its row number is constant.

Partitioning: the distinct (email, dt) rows shuffle once; the window and both
aggregates after it reuse one shuffle on email, and a committer's window holds
one row per active day, however many commits they made.  The per-committer
result passes an exchange that the global maximum and the comparison with it
both read, so the window is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_activity(fact: DataFrame) -> DataFrame:
    """(committer_email, dt, has_commit); has_commit = IF(SUM(count) = 0, 0, 1).

    has_commit is informational: like the original query, later stages count
    every listed day, including a day whose counts sum to 0.
    """
    total = F.sum("commit_count")
    return (fact.groupBy("committer_email", "dt")
            .agg(F.when(total == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("has_commit")))


def _by_committer() -> Window:
    return Window.partitionBy("committer_email").orderBy("dt")


def streak_boundaries(daily: DataFrame) -> DataFrame:
    """new_streak = 1 when there is no earlier day or the gap exceeds one day."""
    prev = F.lag("dt").over(_by_committer())
    new = F.when(prev.isNull() | (F.datediff(F.col("dt"), prev) > 1), F.lit(1)).otherwise(F.lit(0))
    return daily.select("committer_email", "dt", new.cast("bigint").alias("new_streak"))


def streak_groups(boundaries: DataFrame) -> DataFrame:
    """Running count of streak starts; rows are unique per (email, dt), so the
    default RANGE frame equals a ROWS frame."""
    run = F.sum("new_streak").over(_by_committer()
                                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return boundaries.select("committer_email", "dt", run.cast("bigint").alias("streak_group"))


def streak_lengths(groups: DataFrame) -> DataFrame:
    return (groups.groupBy("committer_email", "streak_group")
            .agg(F.count(F.lit(1)).alias("streak_length")))


def committers_at_best(per: DataFrame) -> DataFrame:
    """Rows (committer_email, longest_streak) that hold the largest length, ties included."""
    per = per.repartition("committer_email")     # read by both branches below
    # The maximum reads both columns, so both branches share one exchange.
    best = per.agg(F.max(F.struct("longest_streak", "committer_email")).alias("_b")).select(F.col("_b.longest_streak").alias("_best"))
    return (per.join(best, per["longest_streak"] == best["_best"], "inner")
            .select("committer_email", "longest_streak"))


def longest_streak(fact: DataFrame) -> DataFrame:
    """Committer(s) with the longest streak: (committer_email, longest_streak)."""
    days = fact.select("committer_email", "dt").distinct()
    island = F.date_sub(F.col("dt"), F.row_number().over(_by_committer()))
    lengths = (days.withColumn("island", island).groupBy("committer_email", "island")
               .agg(F.count(F.lit(1)).alias("streak_length")))
    return committers_at_best(lengths.groupBy("committer_email").agg(F.max("streak_length").alias("longest_streak")))


def longest_streak_from_lengths(lengths: DataFrame) -> DataFrame:
    """The same answer from the stages' streak lengths."""
    return committers_at_best(lengths.groupBy("committer_email").agg(F.max("streak_length").alias("longest_streak")))
