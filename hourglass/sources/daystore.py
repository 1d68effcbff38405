"""Day folders ``<root>/dt=YYYY-MM-DD/``: which exist, reading and replacing them.

The folders themselves are the truth; no catalog is consulted.  A read names
the exact day folders it wants, so only their files are listed, and a folder
whose name is not a date (``dt=2024-01-02_old``) is never read as a day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass
class DayWrite:
    """Outcome of one day replacement: the days that received rows, and the
    days of the range that are now empty."""
    days: list[_dt.date]
    empty_days: list[_dt.date]


def day_range(first: _dt.date, last: _dt.date) -> list[_dt.date]:
    return [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def make_folder(spark: SparkSession, root: str) -> None:
    fs, path = _fs(spark, root)
    fs.mkdirs(path)


def remove_folder(spark: SparkSession, root: str) -> None:
    fs, path = _fs(spark, root)
    fs.delete(path, True)


def existing_days(spark: SparkSession, root: str, first: _dt.date | None = None, last: _dt.date | None = None,
                  column: str = "dt") -> dict[_dt.date, str]:
    """Day -> folder, from one listing of the root (its day folders, not their files)."""
    fs, path = _fs(spark, root)
    out = {}
    if not fs.exists(path):
        return out
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            try:
                day = _dt.date.fromisoformat(name[len(column) + 1:])
            except ValueError:
                continue
            if name == f"{column}={day.isoformat()}" and (first is None or day >= first) and (last is None or day <= last):
                out[day] = f"{root.rstrip('/')}/{name}"
    return dict(sorted(out.items()))


def _files(spark: SparkSession, folders: dict[_dt.date, str]) -> dict[_dt.date, set[str]]:
    out = {}
    for day, folder in folders.items():
        fs, path = _fs(spark, folder)
        names = (s.getPath().getName() for s in fs.listStatus(path))
        out[day] = {n for n in names if not n.startswith(("_", "."))}
    return out


def zero_byte_files(spark: SparkSession, folders: dict[_dt.date, str], file_glob: str) -> list[tuple[_dt.date, str]]:
    """(day, path) of the files without a byte, which no reader of Spark's shows."""
    out = []
    for day, folder in folders.items():
        fs, path = _fs(spark, folder)
        for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, file_glob)):
            if status.isFile() and status.getLen() == 0:
                out.append((day, status.getPath().toString()))
    return out


@contextmanager
def _few_listers(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core, where Spark would start a task for each of up to 10,000."""
    before = spark.conf.get(LISTERS)
    spark.conf.set(LISTERS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTERS, before)


def read_paths(reader, spark: SparkSession, root: str, fmt: str, schema: StructType, paths: list[str]) -> DataFrame:
    """The rows of folders and files below ``root``."""
    if not paths:
        return spark.createDataFrame([], schema)
    with _few_listers(spark):     # loading lists the files
        return reader.schema(schema).option("basePath", root).format(fmt).load(paths)


def read_days(reader, spark: SparkSession, root: str, fmt: str, schema: StructType,
              first: _dt.date | None = None, last: _dt.date | None = None, column: str = "dt") -> DataFrame:
    """The rows of days first..last (all days if not given); ``reader`` holds the format's options."""
    return read_paths(reader, spark, root, fmt, schema, list(existing_days(spark, root, first, last, column).values()))


def computed_once(rows: DataFrame) -> DataFrame:
    """The same rows behind an operator that filters on their columns are not
    pushed through: a filter on a computed column then reads its value, where
    Spark would compute the column once more for every mention."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in rows.columns]
    return rows.select(F.inline(F.array(F.struct(*columns))))


def replace_days(rows: DataFrame, root: str, fmt: str, first: _dt.date, last: _dt.date, *,
                 column: str = "dt", rebalance: bool = True) -> DayWrite:
    """Make days first..last below ``root`` hold exactly ``rows`` (restricted to those days).

    Days that receive rows are replaced by dynamic partition overwrite when
    the write commits.  Which days those are is read from the folders: a day
    with a file that was not there before.  The other days of the range are
    removed, and only they; a write or a listing that fails raises before
    anything is removed.
    """
    spark = rows.sparkSession
    make_folder(spark, root)
    before = _files(spark, existing_days(spark, root, first, last, column))
    out = computed_once(rows).where(F.col(column).between(F.lit(first), F.lit(last)))
    if rebalance:
        out = out.hint("rebalance", column)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).format(fmt).save(root))
    folders = existing_days(spark, root, first, last, column)
    written = [day for day, files in _files(spark, folders).items() if files - before.get(day, set())]
    for day in sorted(set(folders) - set(written)):
        remove_folder(spark, folders[day])
    return DayWrite(written, [d for d in day_range(first, last) if d not in set(written)])
