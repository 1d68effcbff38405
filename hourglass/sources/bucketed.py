"""The fact bucketed on its merge key, so that a merge leaves the target where it lies.

Each day's rows are stored in ``buckets`` files by a hash of the merge key,
sorted by it.  A merge reads the run's days as they are: only the source, one
row per key after its aggregate, is dealt to the same buckets, and the result
is written back by the tasks that hold them.  The price is one file per bucket
and day, so this pays where days are large; ``buckets`` should be at least the
session's shuffle partitions, or Spark deals the target out again.

Bucketing is known to the catalog only, so days are written through the table
(``insertInto`` with dynamic partition overwrite) and read from it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators.facts import FACT_COLUMNS
from hourglass.operators.merge import in_days, upsert_fact
from hourglass.sources.daystore import DayWrite, day_range, remove_folder
from hourglass.sources.schemas import F_COMMITS_HOURLY, FACT_MERGE_KEY


class BucketedFact:
    def __init__(self, spark: SparkSession, name: str, root: str, buckets: int):
        self.spark, self.name, self.root, self.buckets = spark, name, root.rstrip("/"), buckets

    def create(self) -> "BucketedFact":
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in F_COMMITS_HOURLY.fields)
        keys = ", ".join(FACT_MERGE_KEY)
        path = self.root.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet PARTITIONED BY (dt) "
                       f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def merged(self, source: DataFrame, first: _dt.date, last: _dt.date, **how) -> DataFrame:
        """The new rows of days first..last (see ``operators.merge.upsert_fact``)."""
        return upsert_fact(self.table(), source, first, last, **how)

    def replace_days(self, rows: DataFrame, first: _dt.date, last: _dt.date) -> DayWrite:
        """Make days first..last hold exactly ``rows`` (of those days)."""
        held = self._days(first, last)
        new = rows.where(in_days(first, last)).select(*FACT_COLUMNS)
        mode = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            if held:  # rows may be read from the days they replace, so what vanishes goes after the write
                files = self._files(first, last)
                new.write.insertInto(self.name, overwrite=True)
                gone = [d for d in held if self._files(d, d) & files]
            else:
                new.write.insertInto(self.name, overwrite=True)
                gone = []
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        for day in gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (dt = DATE'{day}')")
            remove_folder(self.spark, f"{self.root}/dt={day}")
        written = self._days(first, last)
        return DayWrite(written, [d for d in day_range(first, last) if d not in set(written)])

    def merge(self, source: DataFrame, first: _dt.date, last: _dt.date, **how) -> DayWrite:
        return self.replace_days(self.merged(source, first, last, **how), first, last)

    def _days(self, first: _dt.date, last: _dt.date) -> list[_dt.date]:
        shown = (r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())
        return sorted(d for d in map(_dt.date.fromisoformat, shown) if first <= d <= last)

    def _files(self, first: _dt.date, last: _dt.date) -> set[str]:
        self.spark.catalog.refreshTable(self.name)
        return set(self.table().where(in_days(first, last)).inputFiles())
