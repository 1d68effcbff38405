"""MERGE semantics on plain Parquet, as DataFrame joins over whole days.

Parquet tables support neither MERGE nor DELETE, so each upsert is computed
as the new content of the affected day partitions and written with dynamic
partition overwrite (``sources.warehouse``).  Everything here is a pure
DataFrame function; the ``*_table`` variants return the whole table after the
merge (other days untouched), which is what a reader would see.

Target reads are restricted to the run's days *before* joining: the join
condition of the original statements does not mention ``dt``, so without this
the full table would be scanned and shuffled.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.operators.facts import FACT_COLUMNS
from hourglass.sources.schemas import D_DATE, FACT_MERGE_KEY

D_DATE_COLUMNS = tuple(f.name for f in D_DATE.fields)
DUPLICATE_POLICIES = ("combine", "error")


def in_days(first: _dt.date, last: _dt.date) -> Column:
    return F.col("dt").between(F.lit(first), F.lit(last))


def outside_days(first: _dt.date, last: _dt.date) -> Column:
    # NULL dt rows are never touched by a day-scoped statement.
    return F.col("dt").isNull() | ~F.col("dt").between(F.lit(first), F.lit(last))


# --------------------------------------------------------------------------
# d_date
# --------------------------------------------------------------------------
def upsert_d_date(target: DataFrame, source: DataFrame,
                  first: _dt.date, last: _dt.date) -> DataFrame:
    """New d_date rows for days first..last.

    Matched on ``dt``: the target row stays exactly as it is; a source-only
    day is inserted; a target day of the run with no source row disappears.
    ``source`` holds at most one row per day (``d_date_rows``).  Both sides
    are one row per calendar day of the run, so the join is tiny.
    """
    s = source.where(in_days(first, last)).select(*D_DATE_COLUMNS)
    t = target.where(in_days(first, last)).select(
        *[F.col(c).alias(f"t_{c}") for c in D_DATE_COLUMNS], F.lit(True).alias("_t"))
    j = s.join(t, s["dt"] == t["t_dt"], "left")
    return j.select(*[F.when(F.col("_t"), F.col(f"t_{c}")).otherwise(s[c]).alias(c)
                      for c in D_DATE_COLUMNS])


def merge_d_date_table(target: DataFrame, source: DataFrame,
                       first: _dt.date, last: _dt.date) -> DataFrame:
    keep = target.where(outside_days(first, last)).select(*D_DATE_COLUMNS)
    return keep.unionByName(upsert_d_date(target, source, first, last))


# --------------------------------------------------------------------------
# f_commits_hourly
# --------------------------------------------------------------------------
def combine_duplicate_keys(source: DataFrame) -> DataFrame:
    """One source row per merge key: counts summed, the largest id kept.

    The loader groups by committer_id as well, so one (email, date, hour) can
    arrive with two ids (e.g. -1 and a real one); a MERGE would then match a
    target row twice and fail on the second run.  NULL emails group together
    here (they never match a target row anyway).
    """
    # Grouped on exactly the join keys (dt follows from d_date_id), so the
    # join below reuses this aggregate's partitioning instead of shuffling again.
    return (source.groupBy(*FACT_MERGE_KEY)
            .agg(F.max("committer_id").alias("committer_id"),
                 F.sum("commit_count").alias("commit_count"),
                 F.max("dt").alias("dt"))
            .select(*FACT_COLUMNS))


def upsert_fact(target: DataFrame, source: DataFrame, first: _dt.date, last: _dt.date,
                on_duplicate: str = "combine", delete_zero: bool = True,
                source_combined: bool = False) -> DataFrame:
    """New fact rows for days first..last.

    Matched on (email, hour, date id) with plain ``=`` (NULL emails never
    match): commit_count is updated, the target's committer_id kept.
    Source-only rows are inserted.  Target-only rows of the run's days are set
    to 0, and with ``delete_zero`` every 0-count row of those days is then
    dropped, which together make the day equal to the source aggregate.

    ``source_combined``: the source already has one row per merge key
    (``facts.hourly_fact_by_key``), so combining is skipped.
    ``on_duplicate``: ``combine`` sums rows that share a merge key first;
    ``error`` fails when a target row would match several source rows (the
    original engine's behaviour on a re-run), while unmatched duplicates are
    inserted as separate rows.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    s = source.where(in_days(first, last)).select(*FACT_COLUMNS)
    if on_duplicate == "combine":
        if not source_combined:
            s = combine_duplicate_keys(s)
        s = s.withColumn("_n", F.lit(1))
    else:
        # Same keys as the join, so the window reuses the join's partitioning.
        s = s.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*FACT_MERGE_KEY)))
    s = s.withColumn("_s", F.lit(True))
    t = target.where(in_days(first, last)).select(
        *[F.col(c).alias(f"t_{c}") for c in FACT_COLUMNS], F.lit(True).alias("_t"))
    cond = None
    for k in FACT_MERGE_KEY:
        c = s[k] == t[f"t_{k}"]
        cond = c if cond is None else cond & c
    j = s.join(t, cond, "full_outer")
    if on_duplicate == "error":
        j = j.where(F.when(F.col("_t") & (F.col("_n") > 1), F.raise_error(F.concat(
            F.lit("MERGE would match one target row with several source rows: email="),
            F.col("t_committer_email"), F.lit(", d_date_id="), F.col("t_d_date_id").cast("string"),
            F.lit(", d_time_id="), F.col("t_d_time_id").cast("string")))).otherwise(F.lit(True)))
    src, tgt = F.col("_s").isNotNull(), F.col("_t").isNotNull()

    def pick(c: str) -> Column:
        return F.when(tgt, F.col(f"t_{c}")).otherwise(s[c])

    out = j.select(
        pick("d_date_id").alias("d_date_id"),
        pick("d_time_id").alias("d_time_id"),
        pick("committer_id").alias("committer_id"),
        pick("committer_email").alias("committer_email"),
        F.when(src, s["commit_count"]).otherwise(F.lit(0).cast("bigint")).alias("commit_count"),
        pick("dt").alias("dt"),
    )
    if delete_zero:
        out = out.where(~F.col("commit_count").eqNullSafe(0))
    return out


def merge_fact_table(target: DataFrame, source: DataFrame, first: _dt.date, last: _dt.date,
                     on_duplicate: str = "combine", delete_zero: bool = True) -> DataFrame:
    """Whole fact table after the upsert (and the zero-count delete)."""
    keep = target.where(outside_days(first, last)).select(*FACT_COLUMNS)
    return keep.unionByName(upsert_fact(target, source, first, last, on_duplicate, delete_zero))
