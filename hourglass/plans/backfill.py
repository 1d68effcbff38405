"""Range runs: bronze days -> silver -> gold/staging -> d_date -> fact.

One Spark job per layer covers the whole range (a six-month backfill is one
run, not 180), and every layer replaces exactly the days of the range, so a
run can be repeated or overlapped with an earlier one and gives the same
tables.  A requested day with no commits ends up empty in every layer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.clock import LOCAL_OFFSET_HOURS
from hourglass.operators.dims import d_date_rows
from hourglass.operators.facts import hourly_fact, hourly_fact_by_key
from hourglass.operators.gates import Gates, Watch, check, orphan, several_ids
from hourglass.operators.merge import upsert_d_date, upsert_fact
from hourglass.operators.normalize import normalize_commits, split_tagged, tag_rejects
from hourglass.session import scratch_path
from hourglass.sources.daystore import replace_days
from hourglass.sources.landed import read_bronze, read_silver
from hourglass.sources.warehouse import Warehouse

HOURS = 24


@dataclass
class RunResult:
    first: _dt.date
    last: _dt.date
    empty_days: dict[str, list[_dt.date]]     # per table: days left without rows
    days: dict[str, list[_dt.date]]           # per table: days that received rows
    rejects: DataFrame | None = None


def run_days(wh: Warehouse, first: _dt.date, last: _dt.date, *,
             bronze_root: str | None = None, layout: str = "array", mode: str = "strict",
             offset_hours: int = LOCAL_OFFSET_HOURS, on_duplicate: str = "combine",
             write_silver: bool = True, reject_root: str | None = None, gates: Gates | None = None) -> RunResult:
    """Re-run business days first..last end to end.

    ``mode="strict"`` fails on any invalid record or on a record whose day
    differs from the day folder it was landed in; ``"lenient"`` writes those
    to ``reject_root`` (JSON, by landed day) and loads the rest.  A lenient
    run parses bronze once: the flattened records are written with their
    reject reason to the shared scratch folder, and both sides read from there.
    The rejects of the range's days are replaced like every other layer.

    ``gates``: limits on rejects, duplicate keys and orphans (``operators.gates``).
    A run that breaks the first leaves every layer as it was; one that breaks the
    others leaves the fact as it was (they need an isolated warehouse and
    ``on_duplicate="combine"``).
    """
    gates = gates or Gates()
    if gates.on_fact() and not (wh.isolated and on_duplicate == "combine"):
        raise ValueError("gates on the fact need an isolated warehouse and on_duplicate='combine'")
    if first > last:
        raise ValueError(f"first day {first} is after last day {last}")
    spark = wh.spark
    bronze = read_bronze(spark, bronze_root or wh.bronze_path(), first, last, layout, mode)
    writes = {}
    rejects = None
    if mode == "strict":
        rows = normalize_commits(bronze, offset_hours, "strict", keep=("landed_dt",))
        rows = rows.where(F.when(F.col("dt").eqNullSafe(F.col("landed_dt")), F.lit(True))
                          .otherwise(F.raise_error(F.concat(
                              F.lit("commit landed in the wrong day folder: sha="),
                              F.col("commit_sha")))))
    else:
        tagged = tag_rejects(bronze, offset_hours, keep=("landed_dt",))
        misplaced = F.when(F.col("reject_reason").isNull() & ~F.col("dt").eqNullSafe(F.col("landed_dt")),
                           F.lit("wrong_day_folder"))
        tagged = tagged.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), misplaced))
        held = scratch_path(spark, "tagged")
        watch = Watch(rejected=F.col("reject_reason").isNotNull())
        watch.over(tagged).write.parquet(held)
        if gates.reject_share is not None:
            seen = watch.counts()
            check("share of rejected records", seen["rejected"] / max(seen["rows"], 1), gates.reject_share)
        rows, rejects = split_tagged(spark.read.schema(tagged.schema).parquet(held), keep=("landed_dt",))
        if reject_root:
            replace_days(rejects, reject_root, "json", first, last, column="landed_dt")
    rows = rows.drop("landed_dt")

    # silver (JSON) then gold (Parquet, the staging table) converted from it.
    # Spark deals small files to tasks by size, so a day of many pages is spread
    # over many tasks: the flat rows are rebalanced on dt, which gives each day
    # a few even files.  Gold is converted from silver's compacted days.
    if write_silver:
        writes["silver_commits"] = wh.replace_days("silver_commits", rows, first, last)
        gold_in = wh.days("silver_commits", first, last) if wh.isolated else read_silver(spark, wh.path("silver_commits"), first, last)
    else:
        gold_in = rows
    writes["staging_commits"] = wh.replace_days("staging_commits", gold_in, first, last, rebalance=not write_silver)

    staging = wh.days("staging_commits", first, last)
    # d_date before the fact, so every fact row has its date row when readers
    # look.  The staging days are known from the folders that the staging write
    # changed (at most one per day of the range), so no scan finds them.
    staged = spark.createDataFrame([(d,) for d in writes["staging_commits"].days], "dt date")
    new_dates = upsert_d_date(wh.days("d_date", first, last), d_date_rows(staged), first, last)
    # One row per day: no rebalance needed for one file per day.
    writes["d_date"] = wh.replace_days("d_date", new_dates, first, last, rebalance=False)
    # Without staging days there is no source row to look at.
    watched = gates.on_fact() and bool(writes["staging_commits"].days)
    keys = Watch(duplicates=F.col("several"))
    if on_duplicate == "combine":
        source = hourly_fact_by_key(staging, offset_hours, several_ids() if watched else None)      # one aggregation, keyed for the join
    else:
        source = hourly_fact(staging, offset_hours)             # as-written grain, duplicates kept
    if watched:
        source = keys.over(source).drop("several")
    new_fact = upsert_fact(wh.days("f_commits_hourly", first, last), source, first, last,
                           on_duplicate=on_duplicate, delete_zero=True,
                           source_combined=on_duplicate == "combine")
    gate = None
    if watched:
        hours = [r["d_time_id"] for r in wh.table("d_time").select("d_time_id").distinct().limit(HOURS).collect()]
        links = Watch(orphans=orphan(writes["d_date"].days, hours))
        new_fact = links.over(new_fact)

        def gate():
            check("merge keys with several committer ids", keys.counts()["duplicates"], gates.duplicate_keys)
            check("fact rows without a date or hour row", links.counts()["orphans"], gates.orphans)
    writes["f_commits_hourly"] = wh.replace_days("f_commits_hourly", new_fact, first, last, gate=gate)
    return RunResult(first, last, {t: w.empty_days for t, w in writes.items()},
                     {t: w.days for t, w in writes.items()}, rejects)
