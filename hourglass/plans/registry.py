"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver's tables (``events``) and derives everything else with
Spark, so its work grows with the data.  The DuckDB text for each is in
``plans.oracle`` under the same name, with the same column names.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.clock import (
    api_window_text,
    local_day,
    local_day_window,
    local_hour,
    parse_commit_ts,
    to_local,
)
from hourglass.operators import checks, streaks
from hourglass.operators.dims import d_date_rows, d_time
from hourglass.operators.facts import hourly_fact
from hourglass.operators.heatmap import fact_enriched, heatmap
from hourglass.operators.merge import merge_d_date_table, merge_fact_table
from hourglass.operators.normalize import normalize_commits, split_rejects
from hourglass.plans import analytics, files, scenarios as sc
from hourglass.sources.events import events_as_bronze, events_as_faulty_bronze, read_events
from hourglass.sources.schemas import FACT_MERGE_KEY

Query = Callable[[SparkSession, str], DataFrame]


# --- step 1: normalise, local time, fact, top committers --------------------
def q_normalize_commits(spark, sf_dir):
    return sc.staging(spark, sf_dir, "fine")


def q_local_time(spark, sf_dir):
    s = sc.staging(spark, sf_dir, "fine")
    ts = parse_commit_ts(F.col("committer_date"))
    return s.select("commit_sha", "committer_date", to_local(ts).alias("local_ts"),
                    local_hour(ts).alias("d_time_id"), "dt")


def q_f_commits_hourly(spark, sf_dir):
    return sc.fact(spark, sf_dir, "fine")


def q_committer_totals(spark, sf_dir):
    return analytics.committer_totals(sc.fact(spark, sf_dir, "fine"))


def q_committer_rank(spark, sf_dir):
    return analytics.committer_rank(sc.fact(spark, sf_dir, "fine"))


def q_top_committers(spark, sf_dir):
    return analytics.top_committers(sc.fact(spark, sf_dir, "fine"), 5)


# --- step 2: dimensions and heat maps ----------------------------------------
def q_d_date(spark, sf_dir):
    return sc.d_date(spark, sf_dir, "fine")


def _fact_and_dates(spark, sf_dir, email):
    """The fact and the date rows of its days.  A fact row exists for every
    commit, so its days are those of the commits (read from their times alone;
    on written tables d_date is simply read)."""
    return sc.fact(spark, sf_dir, email), d_date_rows(sc.observed_days(read_events(spark, sf_dir)))


def _gaps(d_date):
    """A date dimension without every sixth day of a month."""
    return d_date.where(F.dayofmonth("dt") % 6 != 0)


def q_fact_enriched_gaps(spark, sf_dir):
    f, dd = _fact_and_dates(spark, sf_dir, "coarse")
    return fact_enriched(f, _gaps(dd), d_time(spark, "3h"))


def q_heatmap_gaps(spark, sf_dir):
    f, dd = _fact_and_dates(spark, sf_dir, "coarse")
    return heatmap(f, _gaps(dd), d_time(spark, "3h"))


def q_fact_enriched(spark, sf_dir):
    f, dd = _fact_and_dates(spark, sf_dir, "coarse")
    return fact_enriched(f, dd, d_time(spark, "3h"))


def _heat(variant: str, distinct_first: bool) -> Query:
    def q(spark, sf_dir):
        f, dd = _fact_and_dates(spark, sf_dir, "coarse")
        return heatmap(f, dd, d_time(spark, variant), distinct_first=distinct_first)
    return q


def _hours(variant: str) -> Query:
    """The hour dimension with the commits of each hour: all 24 rows, LEFT
    JOIN so an hour without commits shows 0."""
    def q(spark, sf_dir):
        per = (sc.fact(spark, sf_dir, "fine").groupBy("d_time_id")
               .agg(F.sum("commit_count").alias("commit_count")))
        return (d_time(spark, variant).join(per, "d_time_id", "left")
                .select("d_time_id", "hour_range_str",
                        F.coalesce(F.col("commit_count"), F.lit(0)).cast("bigint").alias("commit_count")))
    return q


# --- step 3: streaks ---------------------------------------------------------
def q_daily_activity(spark, sf_dir):
    return streaks.daily_activity(sc.fact(spark, sf_dir, "fine"))


def q_streak_boundaries(spark, sf_dir):
    return streaks.streak_boundaries(q_daily_activity(spark, sf_dir))


def q_streak_groups(spark, sf_dir):
    return streaks.streak_groups(q_streak_boundaries(spark, sf_dir))


def q_streak_lengths(spark, sf_dir):
    return streaks.streak_lengths(q_streak_groups(spark, sf_dir))


def q_longest_streak(spark, sf_dir):
    return analytics.committers_longest_streak(sc.fact(spark, sf_dir, "fine"))


# --- step 4: merges ------------------------------------------------------------
def q_merge_d_date(spark, sf_dir):
    days = sc.run_days_of(spark, sf_dir)
    return merge_d_date_table(sc.target_d_date(spark, sf_dir, days), d_date_rows(sc.source_staging(spark, sf_dir, days)), days[0], days[-1])


def _merged(spark, sf_dir, delete_zero: bool):
    days = sc.run_days_of(spark, sf_dir)
    return merge_fact_table(sc.target_fact(spark, sf_dir, days), hourly_fact(sc.source_staging(spark, sf_dir, days)),
                            days[0], days[-1], "combine", delete_zero=delete_zero)


def q_merge_fact(spark, sf_dir):
    """The MERGE statement alone: target-only rows of the run are kept at 0."""
    return _merged(spark, sf_dir, delete_zero=False)


def q_fact_delete_zero(spark, sf_dir):
    """MERGE followed by the zero-count DELETE: the table a reader sees."""
    return _merged(spark, sf_dir, delete_zero=True)


def q_merge_error_policy(spark, sf_dir):
    """The as-written policy on a first load of the run's days: keys that the
    source holds twice match nothing and are inserted twice (a second run
    would fail)."""
    days = sc.run_days_of(spark, sf_dir)
    target = sc.target_fact(spark, sf_dir, days).where(~F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    return merge_fact_table(target, sc.fact(spark, sf_dir, "dirty"), days[0], days[-1], "error")


# --- step 5: extraction rules ------------------------------------------------
def _window(spark, sf_dir, inner: int):
    """Commits per business day as extracted with the API window predicate,
    from ``inner`` days after the first day to as many before the last."""
    first, last = sc.bounds(spark, sf_dir)
    inside = _dt.timedelta(days=inner)
    picked = read_events(spark, sf_dir).where(local_day_window(F.col("ts"), first + inside, last - inside))
    day = local_day(F.col("ts"))
    since, until = api_window_text(F.col("dt"))
    return (picked.groupBy(day.alias("dt")).agg(F.count(F.lit(1)).alias("commits"))
            .select("dt", since.alias("api_since"), until.alias("api_until"), "commits"))


def q_local_day_window(spark, sf_dir):
    return _window(spark, sf_dir, 0)


def q_local_day_window_inner(spark, sf_dir):
    return _window(spark, sf_dir, 4)


def q_partition_guard(spark, sf_dir):
    """Rows an extractor that cut days at UTC midnight would land in the wrong
    day partition: (commit_sha, landed_dt, dt)."""
    b = events_as_bronze(read_events(spark, sf_dir), "dirty").withColumn(
        "landed_dt", F.col("ts").cast("date"))
    rows = normalize_commits(b, keep=("landed_dt",))
    return checks.partition_guard(rows).select("commit_sha", "landed_dt", "dt")


# --- step 6: quality -----------------------------------------------------------
def q_reject_split(spark, sf_dir):
    _, bad = split_rejects(events_as_faulty_bronze(read_events(spark, sf_dir)))
    return bad.select("commit_sha", "committer_date", "reject_reason")


def q_pk_violations(spark, sf_dir):
    """Merge keys that the loader's grain (with committer_id) emits twice."""
    return checks.pk_violations(sc.fact(spark, sf_dir, "fine"), list(FACT_MERGE_KEY))


def q_pk_violations_sha(spark, sf_dir):
    """The declared key of staging: commits that two pages both hold."""
    rows = sc.staging(spark, sf_dir, "fine").select("commit_sha")
    again = rows.where(F.col("commit_sha").cast("bigint") % 13 == 0)
    return checks.pk_violations(rows.union(again), ["commit_sha"])


def q_pk_violations_d_date(spark, sf_dir):
    """The declared key of d_date, after an append in place of a merge."""
    days = sc.run_days_of(spark, sf_dir)
    rows = sc.d_date(spark, sf_dir, "dirty")
    return checks.pk_violations(rows.union(rows.where(F.col("dt") >= F.lit(days[0]))), ["d_date_id"])


def q_pk_violations_declared(spark, sf_dir):
    """The fact's declared key (email, date), which its hourly grain breaks."""
    return checks.pk_violations(sc.fact(spark, sf_dir, "dirty"), ["committer_email", "d_date_id"])


def q_fk_orphans(spark, sf_dir):
    """Fact rows whose day has no d_date row: the full fact against the
    merge target's date dimension."""
    return checks.fk_orphans(sc.fact(spark, sf_dir, "dirty"), sc.target_d_date(spark, sf_dir, sc.run_days_of(spark, sf_dir)), "d_date_id")


def q_fk_orphans_d_time(spark, sf_dir):
    """The same for hours, against a dimension that lacks every sixth one."""
    some = d_time(spark, "3h").where(F.col("d_time_id") % 6 != 0)
    return checks.fk_orphans(sc.fact(spark, sf_dir, "dirty"), some, "d_time_id")


def queries() -> dict[str, Query]:
    return {
        "normalize_commits": q_normalize_commits,
        "local_time": q_local_time,
        "f_commits_hourly": q_f_commits_hourly,
        "committer_totals": q_committer_totals,
        "committer_rank": q_committer_rank,
        "top_committers": q_top_committers,
        "d_date": q_d_date,
        "d_time_3h": _hours("3h"),
        "d_time_literal": _hours("literal"),
        "fact_enriched": q_fact_enriched,
        "heatmap": _heat("3h", False),
        "heatmap_distinct_3h": _heat("3h", True),
        "heatmap_literal": _heat("literal", True),
        "fact_enriched_gaps": q_fact_enriched_gaps,
        "heatmap_gaps": q_heatmap_gaps,
        "daily_activity": q_daily_activity,
        "streak_boundaries": q_streak_boundaries,
        "streak_groups": q_streak_groups,
        "streak_lengths": q_streak_lengths,
        "longest_streak": q_longest_streak,
        "merge_d_date": q_merge_d_date,
        "merge_fact": q_merge_fact,
        "fact_delete_zero": q_fact_delete_zero,
        "merge_error_policy": q_merge_error_policy,
        "local_day_window": q_local_day_window,
        "local_day_window_inner": q_local_day_window_inner,
        "partition_guard": q_partition_guard,
        "reject_split": q_reject_split,
        "pk_violations": q_pk_violations,
        "pk_violations_sha": q_pk_violations_sha,
        "pk_violations_d_date": q_pk_violations_d_date,
        "pk_violations_declared": q_pk_violations_declared,
        "fk_orphans": q_fk_orphans,
        "fk_orphans_d_time": q_fk_orphans_d_time,
        **files.queries(),
    }
