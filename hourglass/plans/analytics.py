"""The three analyst questions, over fact/dimension DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators.heatmap import heatmap
from hourglass.operators.ranking import rank_desc, top_k_ranked
from hourglass.operators.streaks import longest_streak


def committer_totals(fact: DataFrame) -> DataFrame:
    """SUM(commit_count) per email: (committer_email, sum_count)."""
    return fact.groupBy("committer_email").agg(F.sum("commit_count").cast("bigint").alias("sum_count"))


def committer_rank(fact: DataFrame) -> DataFrame:
    """Every committer with RANK() OVER (ORDER BY sum_count DESC) as ``r``."""
    return rank_desc(committer_totals(fact), "sum_count", ["committer_email"], "r").select(
        "committer_email", "sum_count", "r")


def top_committers(fact: DataFrame, k: int = 5) -> DataFrame:
    """Top-k committers by total commits with their rank (ties at the cut
    decided by email)."""
    return top_k_ranked(committer_totals(fact), "sum_count", k, ["committer_email"], "r").select(
        "committer_email", "sum_count", "r")


def committers_longest_streak(fact: DataFrame) -> DataFrame:
    return longest_streak(fact)


def weekday_hour_heatmap(fact: DataFrame, d_date: DataFrame, d_time: DataFrame,
                         distinct_first: bool = False, dates: Column | None = None) -> DataFrame:
    return heatmap(fact, d_date, d_time, distinct_first=distinct_first, dates=dates)
