"""Arrival of bronze files re-runs the days they belong to.

The batch design re-runs whole business days, so no per-row state is kept.
``poll_bronze`` compares the bronze files (path, size, modification time) with
those of the last poll and re-runs (``plans.backfill.run_days``) the days
that changed.  A day counts as changed by a new file, an overwritten one (the
extractor lands ``commits.json`` again under the same name), an empty one
(``[]``, a day that lost its commits) or a removed one: days come from file
paths, not from rows.  What was seen is written as a new version of a small
table after the days have run, so a poll that fails is repeated as a whole,
and as day replacement is idempotent, to the same tables.

``start_bronze_trigger`` polls whenever Structured Streaming's file source
finds new files, once at its start, and, with ``processing_time``, at every
trigger, which also finds files overwritten in place.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourglass.plans.backfill import run_days
from hourglass.session import scratch_path
from hourglass.sources.daystore import existing_days, make_folder
from hourglass.sources.warehouse import Warehouse

# What Spark's binary file source can say about a file; the content is never read.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_SEEN = "path string, modified timestamp, length bigint, dt date"


def contiguous_ranges(days: list[_dt.date]) -> list[tuple[_dt.date, _dt.date]]:
    """[d1, d2, d3, d7] -> [(d1, d3), (d7, d7)]"""
    out: list[tuple[_dt.date, _dt.date]] = []
    for d in sorted(set(days)):
        if out and (d - out[-1][1]).days == 1:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def _bronze_files(spark: SparkSession, root: str, since: _dt.date | None) -> DataFrame:
    folders = list(existing_days(spark, root, since).values())
    if not folders:
        return spark.createDataFrame([], _SEEN)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folders)
    return files.select("path", F.col("modificationTime").alias("modified"), "length",
                        F.regexp_extract("path", r"/dt=(\d{4}-\d{2}-\d{2})/", 1).cast("date").alias("dt"))


def _versions(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = (n for n in names if n.startswith("seen-") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))
    return sorted(whole)


def poll_bronze(wh: Warehouse, state: str, *, bronze_root: str | None = None, layout: str = "array",
                since: _dt.date | None = None, **run_kwargs) -> list[_dt.date]:
    """Re-run the days whose bronze files changed since the last poll with
    this ``state`` folder; returns them.  ``since``: days before it are
    neither listed nor compared."""
    spark, root = wh.spark, bronze_root or wh.bronze_path()
    versions = _versions(spark, state)
    # Sizes and times are fixed before the days run: a file that changes meanwhile is found by the next poll.
    pending = scratch_path(spark, "bronze-files")
    _bronze_files(spark, root, since).write.parquet(pending)
    now = spark.read.schema(_SEEN).parquet(pending)
    seen = spark.read.schema(_SEEN).parquet(f"{state}/{versions[-1]}") if versions else spark.createDataFrame([], _SEEN)
    recent = seen if since is None else seen.where(F.col("dt") >= F.lit(since))
    changed = now.exceptAll(recent).union(recent.exceptAll(now))
    # One row per changed day: bounded by the calendar.
    days = sorted(r.dt for r in changed.select("dt").where("dt IS NOT NULL").distinct().collect())
    if not days:
        return []
    landed = now.union(seen.where(F.col("dt") < F.lit(since))) if since is not None else now
    make_folder(spark, state)
    target = f"{state}/seen-{len(versions):08d}"
    for first, last in contiguous_ranges(days):
        run_days(wh, first, last, bronze_root=root, layout=layout, **run_kwargs)
    landed.write.mode("overwrite").parquet(target)
    return days


def start_bronze_trigger(wh: Warehouse, checkpoint_location: str | None = None, *,
                         bronze_root: str | None = None, layout: str = "array",
                         max_files_per_trigger: int | None = None,
                         available_now: bool = False, processing_time: str | None = None,
                         since: _dt.date | None = None, **run_kwargs) -> StreamingQuery:
    """Start the trigger; ``run_kwargs`` go to ``run_days`` (mode, offset...).

    The checkpoint folder must be durable and stable across restarts; it
    defaults to ``<warehouse root>/_checkpoints/bronze_trigger``.
    """
    spark = wh.spark
    root = bronze_root or wh.bronze_path()
    checkpoint = checkpoint_location or os.path.join(wh.root, "_checkpoints", "bronze_trigger")

    def poll() -> None:
        poll_bronze(wh, f"{checkpoint}/seen", bronze_root=root, layout=layout, since=since, **run_kwargs)

    poll()
    reader = spark.readStream.schema(_FILE).option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    make_folder(spark, root)
    ticks = reader.format("binaryFile").load(root).select("path")
    if processing_time:  # a clock beside the files, so that every trigger polls
        ticks = ticks.union(spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("value").cast("string")))
    writer = (ticks.writeStream.foreachBatch(lambda batch, epoch: poll())
              .option("checkpointLocation", f"{checkpoint}/stream"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
