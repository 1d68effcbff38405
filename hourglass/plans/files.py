"""Registered queries that go through files.

Each call lands the driver's events as bronze JSON in a fresh folder below
the session's shared checkpoint root (``spark.checkpoint.dir``), runs the
file plans on it and returns a DataFrame read back from what was written.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.functions.clock import local_day
from hourglass.operators.facts import hourly_fact
from hourglass.operators.gates import GateClosed, Gates
from hourglass.operators.normalize import normalize_commits
from hourglass.plans import scenarios as sc
from hourglass.plans.analytics import weekday_hour_heatmap
from hourglass.sources.bucketed import BucketedFact
from hourglass.sources.events import events_as_bronze, events_as_faulty_bronze, read_events
from hourglass.operators.streak_months import StreakMonths
from hourglass.sources.daystore import computed_once, read_days, replace_days
from hourglass.sources.key_filters import KeyFilters
from hourglass.sources.landed import land_arrays, land_bronze, land_pages, read_bronze, read_gold, read_silver
from hourglass.sources.schemas import F_COMMITS_HOURLY, FACT_MERGE_KEY, STAGING, STAGING_COLUMNS
from hourglass.sources.warehouse import Warehouse
from hourglass.session import scratch_path

API_PAGE_SIZE = 100   # commits per page of the extractor
RANGE_SIZE, RANGE_BYTES = "spark.sql.files.maxPartitionBytes", "65536"


def _landed(spark: SparkSession, sf_dir: str, email: str) -> DataFrame:
    return events_as_bronze(read_events(spark, sf_dir), email).withColumn("dt", local_day(F.col("ts")))


def _land(spark: SparkSession, sf_dir: str, email: str, root: str,
          records_per_file: int | None = None) -> tuple[_dt.date, _dt.date]:
    """Land events as bronze day folders; returns the first and last day."""
    land_bronze(_landed(spark, sf_dir, email), root, records_per_file)
    return sc.bounds(spark, sf_dir)


def _warehouse(spark: SparkSession, label: str, **how) -> Warehouse:
    root = scratch_path(spark, label)
    db = "hg_" + root.rsplit("-", 1)[-1]
    return Warehouse(spark, root, db, **how).create()


def q_bronze_scan(spark, sf_dir):
    """Bronze day folders (JSON Lines) -> normalised commits."""
    root = scratch_path(spark, "bronze")
    first, last = _land(spark, sf_dir, "fine", root)
    return normalize_commits(read_bronze(spark, root, first, last, layout="lines")).select(*STAGING_COLUMNS)


def q_pages_union(spark, sf_dir):
    """Each day landed as many page files of 100 commits; all pages read,
    concatenated without de-duplication."""
    root = scratch_path(spark, "pages")
    first, last = _land(spark, sf_dir, "fine", root, records_per_file=API_PAGE_SIZE)
    return normalize_commits(read_bronze(spark, root, first, last, layout="lines")).select(*STAGING_COLUMNS)


def _array_scan(spark, sf_dir, page_size: int):
    root = scratch_path(spark, "arrays")
    land_pages(_landed(spark, sf_dir, "fine"), root, page_size)
    first, last = sc.bounds(spark, sf_dir)
    # Spark's text writer names its files .txt
    return normalize_commits(read_bronze(spark, root, first, last, layout="array", file_glob="*.txt")).select(*STAGING_COLUMNS)


def q_bronze_scan_array(spark, sf_dir):
    """Bronze as the extractor lands it: files that hold one JSON array."""
    return _array_scan(spark, sf_dir, 1000)


def q_pages_union_array(spark, sf_dir):
    """The same in pages of at most 100 commits."""
    return _array_scan(spark, sf_dir, API_PAGE_SIZE)


def q_bronze_scan_ranges(spark, sf_dir):
    """Each day landed as one array file, parsed in byte ranges of 64 KB."""
    root, read = scratch_path(spark, "bigarrays"), scratch_path(spark, "ranges")
    land_arrays(_landed(spark, sf_dir, "fine"), root)
    first, last = sc.bounds(spark, sf_dir)
    rows = normalize_commits(read_bronze(spark, root, first, last, layout="array_ranges", file_glob="*.txt")).select(*STAGING_COLUMNS)
    size = spark.conf.get(RANGE_SIZE)
    spark.conf.set(RANGE_SIZE, RANGE_BYTES)      # read when the job is planned, so the job runs here
    try:
        rows.write.parquet(read)
    finally:
        spark.conf.set(RANGE_SIZE, size)
    return spark.read.schema(rows.schema).parquet(read)


def q_pages_until_empty(spark, sf_dir):
    """Days landed as numbered pages of 100 commits, with an empty page after
    the second: what lies behind it is not read."""
    root = scratch_path(spark, "endofpages")
    rows = _landed(spark, sf_dir, "fine").withColumn("n", F.row_number().over(Window.partitionBy("dt").orderBy(F.col("sha").cast("long"))) - 1)
    page = F.floor(F.col("n") / API_PAGE_SIZE)
    rows = rows.withColumn("page", page + F.when(page >= 2, 1).otherwise(0))
    pages = rows.groupBy("dt", "page").agg(F.to_json(F.collect_list(F.struct("sha", "committer", "commit"))).alias("value"))
    empty = rows.select("dt").distinct().select("dt", F.lit(2).cast("long").alias("page"), F.lit("[]").alias("value"))
    pages.unionByName(empty).repartition("dt", "page").write.partitionBy("dt", "page").text(root)
    first, last = sc.bounds(spark, sf_dir)
    return normalize_commits(read_bronze(spark, root, first, last, layout="array", file_glob="*.txt", page_pattern=r"/page=(\d+)/")).select(*STAGING_COLUMNS)


def q_silver_scan(spark, sf_dir):
    wh = _warehouse(spark, "silver")
    first, last = _land(spark, sf_dir, "fine", wh.bronze_path())
    rows = normalize_commits(read_bronze(spark, wh.bronze_path(), first, last, layout="lines"))
    wh.replace_days("silver_commits", rows, first, last)
    return read_silver(spark, wh.path("silver_commits"), first, last).select(*STAGING_COLUMNS)


def q_gold_parquet(spark, sf_dir):
    wh = _warehouse(spark, "gold")
    first, last = _land(spark, sf_dir, "fine", wh.bronze_path())
    rows = normalize_commits(read_bronze(spark, wh.bronze_path(), first, last, layout="lines"))
    wh.replace_days("silver_commits", rows, first, last)
    wh.replace_days("staging_commits", read_silver(spark, wh.path("silver_commits"), first, last),
                    first, last)
    return read_gold(spark, wh.path("staging_commits"), first, last).select(*STAGING_COLUMNS)


def _backfilled(spark, sf_dir, label: str, runs: int = 1, **how) -> Warehouse:
    from hourglass.plans.backfill import run_days
    wh = _warehouse(spark, label, **how)
    first, last = _land(spark, sf_dir, "dirty", wh.bronze_path())
    for _ in range(runs):
        run_days(wh, first, last, layout="lines")
    return wh


def q_backfill_range(spark, sf_dir):
    """Whole date range in one run; the fact table read back."""
    return _backfilled(spark, sf_dir, "backfill").table("f_commits_hourly")


def q_backfill_rerun(spark, sf_dir):
    """The same range run twice: tables equal a single run (idempotent)."""
    return _backfilled(spark, sf_dir, "rerun", runs=2).table("f_commits_hourly")


def q_backfill_switched(spark, sf_dir):
    """A range run into an isolated warehouse; then the run's days again with
    the middle one emptied.  The fact is read as it was before the second run,
    and as it is after it: ``state`` old and new."""
    from hourglass.plans.backfill import run_days
    wh = _backfilled(spark, sf_dir, "switched", isolated=True)
    days = sc.run_days_of(spark, sf_dir)
    old = wh.switched("f_commits_hourly").pinned()
    b = _landed(spark, sf_dir, "dirty").where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    replace_days(b.where(F.col("dt") != F.lit(days[1])).select("sha", "committer", "commit", "dt"),
                 wh.bronze_path(), "json", days[0], days[-1])
    run_days(wh, days[0], days[-1], layout="lines")
    new = wh.table("f_commits_hourly")
    state = lambda rows, name: rows.select(F.lit(name).alias("state"), *new.columns)
    return state(old, "old").unionByName(state(new, "new"))


def q_empty_day_rerun(spark, sf_dir):
    """A range run, then a re-run with the run's middle day re-landed without
    commits: the fact has lost that day and nothing else."""
    from hourglass.plans.backfill import run_days
    wh = _backfilled(spark, sf_dir, "emptyday")
    days = sc.run_days_of(spark, sf_dir)
    b = _landed(spark, sf_dir, "dirty").where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    replace_days(b.where(F.col("dt") != F.lit(days[1])).select("sha", "committer", "commit", "dt"),
                 wh.bronze_path(), "json", days[0], days[-1])
    run_days(wh, days[0], days[-1], layout="lines")
    return wh.table("f_commits_hourly")


def q_merge_reopened(spark, sf_dir):
    """A range run; the same root opened anew under another database, as a new
    process does; a re-run of the run's days with every id raised by 100.  Ids
    of matched keys are the first run's, and all other days are still there."""
    from hourglass.plans.backfill import run_days
    first = _backfilled(spark, sf_dir, "reopened")
    days = sc.run_days_of(spark, sf_dir)
    b = _landed(spark, sf_dir, "dirty").where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    raised = F.transform_values("committer", lambda k, v: (v.cast("bigint") + 100).cast("string"))
    replace_days(b.select("sha", raised.alias("committer"), "commit", "dt"), first.bronze_path(), "json", days[0], days[-1])
    again = Warehouse(spark, first.root, first.database + "_again").create()
    run_days(again, days[0], days[-1], layout="lines")
    return again.table("f_commits_hourly")


def q_merge_fact_bucketed(spark, sf_dir):
    """The merge scenario on a fact bucketed on its merge key; the table read back."""
    root = scratch_path(spark, "bucketed")
    database = "hg_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_catalog'")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (first, last), days = sc.bounds(spark, sf_dir), sc.run_days_of(spark, sf_dir)
    fact = BucketedFact(spark, f"{database}.f_commits_hourly", f"{root}/fact", buckets).create()
    fact.replace_days(sc.target_fact(spark, sf_dir, days).repartition(buckets, *FACT_MERGE_KEY), first, last)
    fact.merge(hourly_fact(sc.source_staging(spark, sf_dir, days)), days[0], days[-1])
    return fact.table()


def q_longest_streak_incremental(spark, sf_dir):
    """Streaks from monthly summaries: the fact is landed without the run's
    days and summarised, then those days are added and only their months are
    summarised again."""
    root, months = scratch_path(spark, "streakfact"), scratch_path(spark, "streakmonths")
    fact = sc.fact(spark, sf_dir, "fine")
    (first, last), days = sc.bounds(spark, sf_dir), sc.run_days_of(spark, sf_dir)
    run = F.col("dt").between(F.lit(days[0]), F.lit(days[-1]))
    replace_days(fact.where(~run), root, "parquet", first, last)
    kept = StreakMonths(spark, months, lambda a, b: read_days(spark.read, spark, root, "parquet", F_COMMITS_HOURLY, a, b))
    kept.update(first, last)
    replace_days(fact.where(run), root, "parquet", days[0], days[-1])
    kept.update(days[0], days[-1])
    return kept.longest_streak()


def q_pk_violations_filtered(spark, sf_dir):
    """Staging's declared key, checked by a run that probes the days' filters:
    all days are landed, then the run's days again with a copy of every commit
    whose sha is divisible by 13."""
    root, filters = scratch_path(spark, "keystaging"), scratch_path(spark, "keyfilters")
    rows = sc.staging(spark, sf_dir, "fine")
    (first, last), days = sc.bounds(spark, sf_dir), sc.run_days_of(spark, sf_dir)
    kept = KeyFilters(spark, filters, ["commit_sha"], lambda a, b: read_days(spark.read, spark, root, "parquet", STAGING, a, b))
    replace_days(rows, root, "parquet", first, last)
    kept.update(first, last)
    run = F.col("dt").between(F.lit(days[0]), F.lit(days[-1]))
    copies = rows.where(F.col("commit_sha").cast("bigint") % 13 == 0).withColumn("dt", F.lit(days[1]))
    replace_days(computed_once(rows).where(run).unionByName(copies), root, "parquet", days[0], days[-1])
    kept.update(days[0], days[-1])
    return kept.violations(days[0], days[-1])


def q_heatmap_weekend(spark, sf_dir):
    """The heat map of Saturdays and Sundays, over the warehouse: the fact's
    other days are not read."""
    wh = _backfilled(spark, sf_dir, "weekend")
    return weekday_hour_heatmap(wh.table("f_commits_hourly"), wh.table("d_date"), wh.table("d_time"), dates=F.col("weekday_number") >= 6)


def _lenient_run(spark, sf_dir, mended: bool = False) -> tuple[Warehouse, str]:
    """Faulty records landed as bronze, then a lenient range run: valid rows
    are loaded, the rest written to a reject folder.  ``mended``: the run's
    days are landed again without faults, and re-run."""
    from hourglass.plans.backfill import run_days
    wh = _warehouse(spark, "lenient")
    land_bronze(events_as_faulty_bronze(read_events(spark, sf_dir)).withColumn("dt", local_day(F.col("ts"))), wh.bronze_path())
    first, last = sc.bounds(spark, sf_dir)
    rejects = scratch_path(spark, "rejects")
    run_days(wh, first, last, layout="lines", mode="lenient", reject_root=rejects)
    if mended:
        days = sc.run_days_of(spark, sf_dir)
        b = _landed(spark, sf_dir, "fine").where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
        land_bronze(b, wh.bronze_path())
        run_days(wh, days[0], days[-1], layout="lines", mode="lenient", reject_root=rejects)
    return wh, rejects


def q_backfill_gated(spark, sf_dir):
    """A lenient range run that allows no reject; then the run's days are
    landed with faulty records and run again: the run stops, and the fact is
    what it was."""
    from hourglass.plans.backfill import run_days
    wh = _warehouse(spark, "gated")
    first, last = _land(spark, sf_dir, "fine", wh.bronze_path())
    how = {"layout": "lines", "mode": "lenient", "gates": Gates(reject_share=0.0)}
    run_days(wh, first, last, **how)
    days = sc.run_days_of(spark, sf_dir)
    faulty = events_as_faulty_bronze(read_events(spark, sf_dir)).withColumn("dt", local_day(F.col("ts")))
    land_bronze(faulty.where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1]))), wh.bronze_path())
    try:
        run_days(wh, days[0], days[-1], **how)
    except GateClosed:
        pass
    return wh.table("f_commits_hourly")


def _rejects(spark, sf_dir, mended: bool):
    _, rejects = _lenient_run(spark, sf_dir, mended)
    return (spark.read.schema("commit_sha STRING, committer_date STRING, reject_reason STRING")
            .json(rejects).select("commit_sha", "committer_date", "reject_reason"))


def q_lenient_rejects(spark, sf_dir):
    """Rejected records of a lenient run, read back from the reject folder."""
    return _rejects(spark, sf_dir, mended=False)


def q_lenient_rejects_rerun(spark, sf_dir):
    """The rejects after days without faults were run again: theirs are gone."""
    return _rejects(spark, sf_dir, mended=True)


def q_lenient_fact(spark, sf_dir):
    """The fact table a lenient run builds from the valid records only."""
    wh, _ = _lenient_run(spark, sf_dir)
    return wh.table("f_commits_hourly")


def q_staging_day(spark, sf_dir):
    """One day of staging_commits: the table is loaded, one day folder read."""
    wh = _warehouse(spark, "stagingday")
    first, last = _land(spark, sf_dir, "dirty", wh.bronze_path())
    rows = normalize_commits(read_bronze(spark, wh.bronze_path(), first, last, layout="lines"))
    wh.replace_days("staging_commits", rows, first, last)
    day = sc.run_days_of(spark, sf_dir)[0]
    return wh.days("staging_commits", day, day).select(*STAGING_COLUMNS)


def queries() -> dict:
    return {
        "bronze_scan": q_bronze_scan,
        "pages_union": q_pages_union,
        "bronze_scan_array": q_bronze_scan_array,
        "pages_union_array": q_pages_union_array,
        "bronze_scan_ranges": q_bronze_scan_ranges,
        "pages_until_empty": q_pages_until_empty,
        "silver_scan": q_silver_scan,
        "gold_parquet": q_gold_parquet,
        "backfill_range": q_backfill_range,
        "backfill_rerun": q_backfill_rerun,
        "staging_day": q_staging_day,
        "backfill_switched": q_backfill_switched,
        "empty_day_rerun": q_empty_day_rerun,
        "merge_reopened": q_merge_reopened,
        "merge_fact_bucketed": q_merge_fact_bucketed,
        "longest_streak_incremental": q_longest_streak_incremental,
        "pk_violations_filtered": q_pk_violations_filtered,
        "heatmap_weekend": q_heatmap_weekend,
        "backfill_gated": q_backfill_gated,
        "lenient_rejects_rerun": q_lenient_rejects_rerun,
        "lenient_rejects": q_lenient_rejects,
        "lenient_fact": q_lenient_fact,
    }


def oracle_sql() -> dict:
    from hourglass.plans.oracle import (D_TIME_3H, FAULTY, RUN, STREAK_CTES, combined_cte, commits_cte, fact_cte, heatmap_sql,
                                        merge_fact_sql, reject_sql)
    staging = f"""WITH {commits_cte('fine')}
SELECT commit_sha, committer_id, committer_name, committer_email, committer_date, dt FROM commits"""
    backfill = f"""WITH {commits_cte('dirty')}, {fact_cte()}, {combined_cte('fact', 'f')}
SELECT d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f"""
    return {
        "bronze_scan": staging,
        "bronze_scan_array": staging,
        "pages_union": staging,
        "pages_union_array": staging,
        "bronze_scan_ranges": staging,
        "pages_until_empty": f"""WITH {commits_cte('fine')}
SELECT commit_sha, committer_id, committer_name, committer_email, committer_date, dt FROM commits
QUALIFY row_number() OVER (PARTITION BY dt ORDER BY CAST(commit_sha AS BIGINT)) <= 200""",
        "merge_fact_bucketed": merge_fact_sql(delete_zero=True),
        "longest_streak_incremental": f"""WITH {STREAK_CTES}
SELECT DISTINCT committer_email, run AS longest_streak FROM runs WHERE run = (SELECT max(run) FROM runs)""",
        "pk_violations_filtered": f"""WITH {commits_cte('fine')}
SELECT commit_sha, CAST(2 AS BIGINT) AS n FROM commits WHERE CAST(commit_sha AS BIGINT) % 13 = 0""",
        "heatmap_weekend": heatmap_sql(D_TIME_3H, distinct=False, email="dirty", rows="isodow(dt) >= 6"),
        "silver_scan": staging,
        "gold_parquet": staging,
        "backfill_range": backfill,
        "backfill_rerun": backfill,
        "backfill_switched": f"""WITH {RUN}, {commits_cte('dirty')}, {fact_cte()}, {combined_cte('fact', 'f')}
SELECT 'old' AS state, d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f
UNION ALL
SELECT 'new', d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f, run WHERE dt <> run.day + 1""",
        "empty_day_rerun": f"""WITH {RUN}, {commits_cte('dirty')}, {fact_cte()}, {combined_cte('fact', 'f')}
SELECT d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f, run WHERE dt <> run.day + 1""",
        # NULL emails never match, so their rows are inserted anew, with the second run's ids
        "merge_reopened": f"""WITH {RUN}, {commits_cte('dirty')}, {fact_cte()}, {combined_cte('fact', 'f')}
SELECT d_date_id, d_time_id,
       CASE WHEN committer_email IS NULL AND dt BETWEEN run.day AND run.day + 2 AND committer_id >= 0
            THEN committer_id + 100 ELSE committer_id END AS committer_id,
       committer_email, commit_count, dt FROM f, run""",
        "backfill_gated": f"""WITH {commits_cte('fine')}, {fact_cte()}, {combined_cte('fact', 'f')}
SELECT d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f""",
        "lenient_rejects": reject_sql(),
        "lenient_rejects_rerun": f"""WITH {RUN}
SELECT r.commit_sha, r.committer_date, r.reject_reason FROM ({reject_sql(', CAST(ts + INTERVAL 7 HOUR AS DATE) AS dt')}) AS r, run
WHERE r.dt NOT BETWEEN run.day AND run.day + 2""",
        "lenient_fact": f"""WITH {commits_cte('fine', where=f'NOT ({FAULTY})')}, {fact_cte()},
{combined_cte('fact', 'f')}
SELECT d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM f""",
        "staging_day": f"""WITH {RUN}, {commits_cte('dirty')}
SELECT commit_sha, committer_id, committer_name, committer_email, committer_date, dt
FROM commits, run WHERE dt = run.day""",
    }
