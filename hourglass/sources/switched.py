"""Day tables whose days are switched, never overwritten.

A write puts its rows into a folder of its own, ``<root>/runs/run=<id>/dt=.../``.
Nothing refers to that folder until one metadata statement per day points the
table's partition to it (``ALTER TABLE ... PARTITION ... SET LOCATION``).  So

* a reader that has listed its files goes on with the old ones, which stay,
* a reader that starts after the switch sees the new day whole,
* a run that stops before the switch has changed nothing; its folder is
  only garbage, and after a run that stops between two days' switches each day is
  either old or new.

Days of the range without rows are dropped from the table.  ``retire`` removes
run folders that no partition names any more, once they are old enough for
every reader to be done.

Here the catalog is the truth, not the folders.  A persistent catalog keeps it
across processes; with Spark's in-memory catalog it ends with the process, and
a table that finds runs on disk but no partitions refuses to open.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.sources.daystore import DayWrite, _fs, day_range, existing_days, remove_folder

RUNS = "runs"


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


class SwitchedTable:
    """``name``: the table in the catalog, partitioned by the DATE column ``column``; ``root``: its folder."""

    def __init__(self, spark: SparkSession, name: str, root: str, fmt: str, column: str = "dt"):
        self.spark, self.name, self.root, self.fmt, self.column = spark, name, root.rstrip("/"), fmt, column

    def opened(self) -> "SwitchedTable":
        """The table, unless its runs are on disk but the catalog knows none of them."""
        if self._runs() and not self.locations():
            raise ValueError(f"{self.name}: {self.root}/{RUNS} holds runs, but the catalog has no partitions. "
                             "Its metadata is lost or belongs to another catalog")
        return self

    def _runs(self) -> dict[str, int]:
        """Run folder -> its age in milliseconds."""
        fs, path = _fs(self.spark, f"{self.root}/{RUNS}")
        if not fs.exists(path):
            return {}
        now = int(time.time() * 1000)
        return {s.getPath().getName(): now - s.getModificationTime() for s in fs.listStatus(path) if s.isDirectory()}

    def locations(self) -> dict[_dt.date, str]:
        """Day -> the folder that its partition names."""
        out = {}
        database, table = self.name.replace("`", "").split(".")
        jvm = self.spark._jvm
        catalog = self.spark._jsparkSession.sessionState().catalog()
        some = jvm.org.apache.spark.sql.catalyst.TableIdentifier(table, jvm.scala.Option.apply(database))
        found = catalog.listPartitions(some, jvm.scala.Option.apply(None))
        for k in range(found.size()):
            part = found.apply(k)
            out[_dt.date.fromisoformat(part.spec().apply(self.column))] = part.location().toString()
        return out

    def write(self, rows: DataFrame, first: _dt.date, last: _dt.date, rebalance: bool = True) -> str:
        """The rows of days first..last in a folder of their own, which nothing refers to yet."""
        run = f"{self.root}/{RUNS}/run={uuid.uuid4().hex}"
        out = rows.where(F.col(self.column).between(F.lit(first), F.lit(last)))
        if rebalance:
            out = out.hint("rebalance", self.column)
        out.write.partitionBy(self.column).format(self.fmt).save(run)
        return run

    def switch(self, run: str, first: _dt.date, last: _dt.date) -> DayWrite:
        """Point days first..last to what the run holds; its days without rows leave the table."""
        new, old = existing_days(self.spark, run, first, last, self.column), self.locations()
        for day, folder in new.items():
            part = f"PARTITION ({self.column} = DATE'{day.isoformat()}')"
            verb = f"{part} SET LOCATION" if day in old else f"ADD IF NOT EXISTS {part} LOCATION"
            self.spark.sql(f"ALTER TABLE {self.name} {verb} {_literal(folder)}")
        empty = [d for d in day_range(first, last) if d not in new]
        for day in empty:
            if day in old:
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self.column} = DATE'{day.isoformat()}')")
        self.spark.catalog.refreshTable(self.name)
        return DayWrite(list(new), empty)

    def replace_days(self, rows: DataFrame, first: _dt.date, last: _dt.date, rebalance: bool = True,
                     gate: Callable[[], None] | None = None) -> DayWrite:
        """``gate`` is called between the write and the switch; if it raises, the table stays as it was."""
        run = self.write(rows, first, last, rebalance)
        if gate:
            gate()
        return self.switch(run, first, last)

    def days(self, first: _dt.date | None, last: _dt.date | None) -> DataFrame:
        """The rows of days first..last as the catalog has them now."""
        rows = self.spark.table(self.name)
        for bound, keep in ((first, rows[self.column] >= F.lit(first)), (last, rows[self.column] <= F.lit(last))):
            rows = rows.where(keep) if bound is not None else rows
        return rows

    def pinned(self, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
        """The same, but from the files that are there now: later switches do not change it."""
        schema = self.spark.table(self.name).schema
        folders = [path for day, path in sorted(self.locations().items()) if (not first or day >= first) and (not last or day <= last)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{RUNS}").format(self.fmt)
        return reader.load(folders).select(*schema.fieldNames())

    def retire(self, older_than_hours: float) -> list[str]:
        """Remove the runs that no partition names and that are older than that; returns their names."""
        named = {p.split(f"/{RUNS}/")[-1].split("/")[0] for p in self.locations().values()}
        gone = [run for run, age in self._runs().items() if run not in named and age >= older_than_hours * 3_600_000]
        for run in gone:
            remove_folder(self.spark, f"{self.root}/{RUNS}/{run}")
        return gone
