"""Key and reference checks for the NOT ENFORCED constraints.

Both are reports (DataFrames of offending rows), so a job can decide to fail,
quarantine or just log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once: keys + ``n``.  NULLs group together."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose non-NULL ``key`` has no row in ``dim``.  The anti
    join is planned from measured sizes."""
    keys = dim.select(F.col(dim_key or key).alias("_k")).distinct()
    f = fact.where(F.col(key).isNotNull())
    return f.join(keys, f[key] == keys["_k"], "left_anti")


def partition_guard(rows: DataFrame, landed: str = "landed_dt") -> DataFrame:
    """Rows whose business day differs from the day partition they landed in.

    A load into day D's partition must only hold rows with dt = D (a
    day-decorated load rejects the file otherwise); the offending rows are
    returned so the caller can fail or quarantine them.
    """
    return rows.where(~F.col("dt").eqNullSafe(F.col(landed)))
