"""Ranking without moving every row to one partition.

``RANK() OVER (ORDER BY v DESC)`` with no PARTITION BY makes Spark sort all
rows in a single task.  Two exact rewrites avoid that:

* top-k: take the k best rows first (TakeOrderedAndProject keeps k rows per
  task), then rank those k rows.  A row's rank only depends on rows ahead of
  it, and every row ahead of a top-k row is itself in the top k.
* full ranking: rows are range-partitioned on (value, tie break), so partitions
  are even however many rows share a value, and written to the shared scratch
  folder with their partition number.  A row's rank is its rank inside its
  partition plus the rows of earlier partitions, less those of them that have
  its own value; these offsets come from one row of counts per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import scratch_path


def rank_desc(df: DataFrame, value: str, tie_break: list[str], rank_col: str = "r") -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY value DESC NULLS LAST)."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in tie_break)]
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    local = ranged.withColumn("_local", F.rank().over(Window.partitionBy("_part").orderBy(F.col(value).desc_nulls_last())))
    # One row per partition: its rows, its largest and smallest value, and how many rows have the smallest.
    counts = local.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(value, -F.col("_local")).alias("_top"),
        F.max_by(value, "_local").alias("_low"), F.max("_local").alias("_last"))
    counts = counts.withColumn("_lows", F.col("_n") - F.col("_last") + 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # Rows of earlier partitions with this partition's largest value: such partitions end in that value.
    held = counts.select(F.col("_low").alias("_value"), F.col("_part").alias("_earlier"), F.col("_lows").alias("_ties"))
    same = (counts.join(held, F.col("_top").eqNullSafe(F.col("_value")) & (F.col("_earlier") < F.col("_part")))
            .groupBy("_part").agg(F.sum("_ties").alias("_same")))
    offsets = counts.join(same, "_part", "left").select("_part", "_top", "_ahead", F.coalesce("_same", F.lit(0)).alias("_same"))
    ranked = local.join(offsets, "_part")
    own = F.col("_ahead") + F.col("_local") - F.when(F.col(value).eqNullSafe(F.col("_top")), F.col("_same")).otherwise(0)
    return ranked.select(*df.columns, own.cast("bigint").alias(rank_col))


def top_k_ranked(df: DataFrame, value: str, k: int, tie_break: list[str],
                 rank_col: str = "r") -> DataFrame:
    """The k rows with the largest ``value`` and their global RANK().

    Ties at the cut are decided by ``tie_break`` (ascending, NULLS FIRST) so
    the answer is deterministic.
    """
    order = [F.col(value).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tie_break]
    best = df.orderBy(*order).limit(int(k))
    # k rows: a single-partition window here is intended.
    w = Window.orderBy(F.col(value).desc_nulls_last())
    return best.withColumn(rank_col, F.rank().over(w).cast("bigint"))
