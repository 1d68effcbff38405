"""The star schema as day-partitioned tables over one root folder.

Every table is partitioned by ``dt`` and rewritten a whole day at a time (see
``sources.daystore``).  The folders are the truth: reads and merges go by day
folder, so a new process, another database or another catalog over the same
root sees all days that were ever written.

A table may be read and rewritten by the same job (the merge reads the target
days it replaces): new files are staged and moved into place at job commit,
after every task has read its input, so a lost executor is simply recomputed
from the old files.  A reader that lists a day during those moves may see it
half replaced; an ``isolated`` warehouse switches whole days instead, and then
the catalog is the truth.

For SQL users the tables are also declared in the session's catalog.
``create`` registers every day folder that exists and each write registers its
own days, so the catalog follows the folders.  With Spark's default in-memory
catalog the declarations (and views) end with the process; a persistent
catalog keeps them.

``d_date`` is kept partitioned by ``dt`` as well (one row per day), which
turns its merge into the same day replacement; ``staging_commits`` is declared
over the gold Parquet folder, so loading gold into staging costs no copy.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hourglass.operators.dims import d_time
from hourglass.sources.daystore import DayWrite, day_range, existing_days, read_days, replace_days
from hourglass.sources.switched import SwitchedTable
from hourglass.sources.schemas import D_DATE, D_TIME, F_COMMITS_HOURLY, STAGING

__all__ = ["TABLES", "DayWrite", "Warehouse", "day_range"]

# name -> (schema, format, folder below the root, partitioned)
TABLES: dict[str, tuple[StructType, str, str, bool]] = {
    "silver_commits": (STAGING, "json", "silver/commits", True),
    "staging_commits": (STAGING, "parquet", "gold/commits", True),
    "d_date": (D_DATE, "parquet", "warehouse/d_date", True),
    "f_commits_hourly": (F_COMMITS_HOURLY, "parquet", "warehouse/f_commits_hourly", True),
    "d_time": (D_TIME, "parquet", "warehouse/d_time", False),
}
DAYS_PER_STATEMENT = 200


def _ddl_columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def _quote(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Warehouse:
    """Tables of one deployment: ``<database>.<name>`` at ``<root>/<folder>``."""

    def __init__(self, spark: SparkSession, root: str, database: str = "hourglass",
                 d_time_variant: str = "3h", isolated: bool = False):
        """``isolated``: days are switched in the catalog instead of
        overwritten, so that no reader sees one half replaced (``sources.switched``)."""
        self.spark = spark
        self.isolated = isolated
        self.root = root.rstrip("/")
        self.database = database
        self.d_time_variant = d_time_variant

    # -- layout -------------------------------------------------------------
    def path(self, name: str) -> str:
        return os.path.join(self.root, TABLES[name][2])

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def bronze_path(self) -> str:
        return os.path.join(self.root, "bronze", "commits")

    def create(self) -> "Warehouse":
        """Create database and tables if missing (idempotent), and register
        the days that the folders hold.  ``d_time`` is computed once, when its
        folder does not exist yet."""
        s = self.spark
        s.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
              f"LOCATION {_quote(os.path.join(self.root, '_catalog'))}")
        for table, (schema, fmt, _, partitioned) in TABLES.items():
            part = "PARTITIONED BY (dt)" if partitioned else ""
            s.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({_ddl_columns(schema)}) "
                  f"USING {fmt} {part} LOCATION {_quote(self.path(table))}")
            if partitioned and self.isolated:
                self.switched(table).opened()
            elif partitioned:
                self._register(table, list(existing_days(s, self.path(table))), [])
        if self.table("d_time").isEmpty():
            d_time(s, self.d_time_variant).write.mode("overwrite").parquet(self.path("d_time"))
            s.catalog.refreshTable(self.name("d_time"))
        return self

    def _register(self, table: str, days: list[_dt.date], gone: list[_dt.date]) -> None:
        """Bring the catalog's partitions in line with the day folders."""
        for verb, some in (("ADD IF NOT EXISTS", days), ("DROP IF EXISTS", gone)):
            for at in range(0, len(some), DAYS_PER_STATEMENT):
                parts = [f"PARTITION (dt = DATE'{d.isoformat()}')" for d in some[at:at + DAYS_PER_STATEMENT]]
                self.spark.sql(f"ALTER TABLE {self.name(table)} {verb} {(' ' if verb.startswith('ADD') else ', ').join(parts)}")
        self.spark.catalog.refreshTable(self.name(table))

    def switched(self, table: str) -> SwitchedTable:
        return SwitchedTable(self.spark, self.name(table), self.path(table), TABLES[table][1])

    def retire(self, older_than_hours: float) -> dict[str, list[str]]:
        """Remove the replaced runs of an isolated warehouse that are older than that, and so not read any more."""
        return {t: self.switched(t).retire(older_than_hours) for t, spec in TABLES.items() if spec[3]} if self.isolated else {}

    def table(self, table: str) -> DataFrame:
        if not TABLES[table][3]:
            return self.spark.table(self.name(table))
        return self.days(table, None, None)

    def days(self, table: str, first: _dt.date | None, last: _dt.date | None) -> DataFrame:
        """The rows of days first..last, read from exactly those day folders."""
        schema, fmt, _, _ = TABLES[table]
        if self.isolated:
            return self.switched(table).days(first, last)
        return read_days(self.spark.read, self.spark, self.path(table), fmt, schema, first, last)

    # -- writes -------------------------------------------------------------
    def replace_days(self, table: str, rows: DataFrame, first: _dt.date, last: _dt.date,
                     rebalance: bool = True, gate: Callable[[], None] | None = None) -> DayWrite:
        """Make days first..last of ``table`` hold exactly ``rows`` (restricted
        to those days).  Returns the days written and the days left empty.

        ``rebalance``: shuffle rows on ``dt`` before writing; AQE merges small
        days into one task and splits a very large day across several, so a
        day gets a few even files instead of one file per input task.  Pass
        False when every day is already in one input task, which saves the
        shuffle.  ``gate`` (isolated warehouses only) is called when the rows
        are written but not yet seen; if it raises, they never are.
        """
        schema, fmt, _, _ = TABLES[table]
        if gate and not self.isolated:
            raise ValueError("a gate needs an isolated warehouse: elsewhere a write is seen as soon as it ends")
        rows = rows.select(*[f.name for f in schema.fields])
        if self.isolated:
            return self.switched(table).replace_days(rows, first, last, rebalance, gate)
        done = replace_days(rows, self.path(table), fmt, first, last, rebalance=rebalance)
        self._register(table, done.days, done.empty_days)
        return done
