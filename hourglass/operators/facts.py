"""Hourly commit fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.clock import LOCAL_OFFSET_HOURS, date_id, local_hour, parse_commit_ts
from hourglass.operators.normalize import LOCAL_TS
from hourglass.sources.schemas import F_COMMITS_HOURLY, FACT_MERGE_KEY

FACT_COLUMNS = tuple(f.name for f in F_COMMITS_HOURLY.fields)


def _hour(staging: DataFrame, offset_hours: int) -> Column:
    """The local hour: from the time a run carries along, else parsed from the text."""
    if LOCAL_TS in staging.columns:
        return F.hour(LOCAL_TS).cast("bigint")
    return local_hour(parse_commit_ts(F.col("committer_date")), offset_hours)


def hourly_fact(staging: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """COUNT(1) per (date id, local hour, committer_id, email, dt).

    This is the grain the loader writes: a committer seen with two ids in one
    hour yields two rows (see ``operators.merge`` for how the upsert treats
    them).  NULL keys form their own groups.  Spark aggregates partially on
    the map side, so a very active committer costs at most 24 rows per day
    per task in the shuffle.
    """
    hour = _hour(staging, offset_hours)
    return (staging
            .groupBy(date_id(F.col("dt")).alias("d_date_id"), hour.alias("d_time_id"),
                     "committer_id", "committer_email", "dt")
            .agg(F.count(F.lit(1)).alias("commit_count"))
            .select(*FACT_COLUMNS))


def hourly_fact_by_key(staging: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS,
                       several: Column | None = None) -> DataFrame:
    """The hourly fact already combined on the merge key (email, hour, date):
    COUNT(1) and the largest committer_id per key, in one aggregation.

    Equal to ``operators.merge.combine_duplicate_keys(hourly_fact(staging))``
    but with one shuffle instead of two, partitioned on the merge key the
    upsert joins on.  ``several``: one more aggregate, kept as column ``several``.
    """
    hour = _hour(staging, offset_hours)
    keyed = staging.select(F.col("committer_email"), hour.alias("d_time_id"),
                           date_id(F.col("dt")).alias("d_date_id"), "committer_id", "dt")
    return (keyed.groupBy(*FACT_MERGE_KEY)
            .agg(F.max("committer_id").alias("committer_id"),
                 F.count(F.lit(1)).alias("commit_count"),
                 F.max("dt").alias("dt"), *([] if several is None else [several.alias("several")]))
            .select(*FACT_COLUMNS, *([] if several is None else ["several"])))
