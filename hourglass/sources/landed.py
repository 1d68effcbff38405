"""Landed JSON layers (bronze, silver) and the gold Parquet layer.

All three are Hive-style day folders ``<root>/dt=YYYY-MM-DD/``.  Reads declare
the schema (never inferred), keep only ``*.json`` files and name the exact
day folders they want (``sources.daystore``), so no other day's files are
listed or read.

Bronze comes in three layouts, chosen by the caller and never guessed:

* ``array``: one JSON array per file, as the REST extractor lands it.  Spark
  must read such a file whole (``multiLine``), one task per file, so
  parallelism comes from the number of files (days x pages).
* ``array_ranges``: the same files, parsed in byte ranges however large they
  are (``sources.array_ranges``).
* ``lines``: JSON Lines, splittable; what Spark itself writes and the layout
  to prefer at scale.

Reading JSON Lines with ``multiLine`` silently keeps only the first record of
each file, so the flag is tied to the declared layout.
"""

from __future__ import annotations

import datetime as _dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from hourglass.sources.array_ranges import read_array_ranges
from hourglass.sources.daystore import existing_days, read_days, read_paths, zero_byte_files
from hourglass.sources.schemas import BRONZE_COMMIT, CORRUPT_COLUMN, STAGING, with_field

LAYOUTS = ("array", "array_ranges", "lines")
GROUP_PAGES = 64    # pages that land_pages fills together
_DT = StructField("dt", DateType())


def _checked(layout: str, mode: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if mode not in ("strict", "lenient"):
        raise ValueError("mode must be 'strict' or 'lenient'")


def _json_reader(spark: SparkSession, layout: str, mode: str, file_glob: str = "*.json"):
    _checked(layout, mode)
    r = (spark.read
         .option("multiLine", layout == "array")
         .option("pathGlobFilter", file_glob)
         .option("mode", "FAILFAST" if mode == "strict" else "PERMISSIVE"))
    if mode == "lenient":
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return r


def read_bronze(spark: SparkSession, root: str, first: _dt.date | None = None,
                last: _dt.date | None = None, layout: str = "array",
                mode: str = "strict", file_glob: str = "*.json", page_pattern: str | None = None) -> DataFrame:
    """Bronze commit objects of days first..last, with the folder's day as
    ``landed_dt``.

    ``page_pattern``: a regular expression whose group is a page's number in
    the file's path.  Then a day ends at its first page without records, as
    an extractor that pages until nothing comes back ends it, and later pages
    are left out.  Which pages that are is found when this is called.

    strict: a malformed file fails the read.  lenient: a malformed record
    becomes a row whose ``_corrupt_record`` holds the text, which
    ``operators.normalize.split_rejects`` routes to the rejects.  Empty files
    and empty arrays give no rows.
    """
    schema = BRONZE_COMMIT
    if mode == "lenient":
        schema = with_field(schema, StructField(CORRUPT_COLUMN, StringType()))
    if layout == "array_ranges":
        _checked(layout, mode)
        if page_pattern:
            raise ValueError("pages are whole files: read them as layout array or lines")
        return read_array_ranges(spark, root, schema, first, last, mode, file_glob, CORRUPT_COLUMN).withColumnRenamed("dt", "landed_dt")
    schema = with_field(schema, _DT)
    reader = _json_reader(spark, layout, mode, file_glob)
    if page_pattern:
        df = read_paths(reader, spark, root, "json", schema, pages_to_read(spark, root, first, last, file_glob, page_pattern))
    else:
        df = read_days(reader, spark, root, "json", schema, first, last)
    return df.select(*schema.fieldNames()).withColumnRenamed("dt", "landed_dt")


def pages_to_read(spark: SparkSession, root: str, first: _dt.date | None, last: _dt.date | None,
                  file_glob: str, page_pattern: str) -> list[str]:
    """Paths that hold the pages before each day's first page without records:
    the folder of a day that is read whole, otherwise the day's files.

    A page holds a record if there is a ``{`` in its text.  Every file with a
    byte gives a line of text; Spark skips the others, so those are listed
    apart, in the day folder itself."""
    folders = existing_days(spark, root, first, last)
    if not folders:
        return []
    schema = StructType([StructField("value", StringType()), _DT])
    text = read_days(spark.read.option("pathGlobFilter", file_glob), spark, root, "text", schema, first, last)
    pages = (text.groupBy(F.col("_metadata.file_path").alias("_file"), "dt")
             .agg(F.max(F.contains("value", F.lit("{"))).alias("filled")))
    blank = [(path, day, False) for day, path in zero_byte_files(spark, folders, file_glob)]
    pages = pages.unionByName(spark.createDataFrame(blank, "_file string, dt date, filled boolean"))
    number = F.regexp_extract("_file", page_pattern, 1).try_cast("long")
    unnamed = F.raise_error(F.concat(F.lit("no page number in "), F.col("_file"))).cast("long")
    day, page = Window.partitionBy("dt"), F.col("page")
    pages = pages.withColumn("page", F.coalesce(number, unnamed))
    pages = pages.withColumn("end", F.min(F.when((page >= 0) & ~F.col("filled"), page)).over(day))
    pages = pages.withColumn("kept", (page >= 0) & (F.col("end").isNull() | (page < F.col("end"))))
    pages = pages.withColumn("whole", F.min("kept").over(day)).where("kept")
    # Names only, and of a day that is read whole only the day's.
    found = pages.select("dt", F.when(~F.col("whole"), F.col("_file")).alias("_file")).distinct().collect()
    return sorted(folders[r["dt"]] if r["_file"] is None else _path_of(r["_file"]) for r in found)


def _path_of(file: str) -> str:
    """The path to load for a ``_metadata.file_path``: that is a URI, and paths are loaded as glob patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def land_bronze(bronze: DataFrame, root: str, records_per_file: int | None = None) -> None:
    """Write commit objects (with a ``dt`` column) as JSON Lines day folders.

    Stands in for the extractor when the source is already in Spark; the
    days written are replaced, other days are left alone.
    ``records_per_file`` caps a file like an API page (100 commits).
    """
    w = (bronze.select("sha", "committer", "commit", "dt").hint("rebalance", "dt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt"))
    if records_per_file:
        w = w.option("maxRecordsPerFile", int(records_per_file))
    w.json(root)


def land_pages(bronze: DataFrame, root: str, page_size: int = 100) -> None:
    """Write commit objects (with a ``dt`` column) as pages: files that hold
    one JSON array of at most ``page_size`` commits each, as the REST extractor
    lands them.  A day's commits are dealt by a hash to groups of about
    ``GROUP_PAGES`` pages, so no group is larger, and a group's pages are full
    but for its last.

    Files are the cost: tasks move their own into the write's staging folder
    (committer version 2), and the days are switched when the job commits.
    """
    rows = bronze.select("dt", F.struct("sha", "committer", "commit").alias("one"), F.xxhash64("sha").alias("place"))
    groups = bronze.groupBy("dt").agg(F.ceil(F.count(F.lit(1)) / (GROUP_PAGES * page_size)).alias("groups"))
    dealt = rows.join(groups, "dt").withColumn("group", F.pmod("place", F.col("groups")))
    spark = bronze.sparkSession
    # A number given is kept: by their bytes, pages would be written by a few tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    row = F.row_number().over(Window.partitionBy("dt", "group").orderBy("place"))
    dealt = dealt.repartition(tasks, "dt", "group").withColumn("page", F.floor((row - 1) / page_size))
    arrays = dealt.groupBy("dt", "group", "page").agg(F.to_json(F.collect_list("one")).alias("value")).select("value", "dt")
    (arrays.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("dt").text(root))


def land_arrays(bronze: DataFrame, root: str) -> None:
    """Write commit objects (with a ``dt`` column) as one file per day that
    holds one JSON array, a commit per line."""
    day = Window.partitionBy("dt")
    rows = bronze.select("dt", F.to_json(F.struct("sha", "committer", "commit")).alias("one"))
    n, rows_of_day = F.row_number().over(day.orderBy("one")), F.count(F.lit(1)).over(day)
    rows = rows.withColumns({"n": n, "of": rows_of_day})
    value = F.concat(F.when(F.col("n") == 1, "[").otherwise(","), F.col("one"), F.when(F.col("n") == F.col("of"), "]").otherwise(""))
    (rows.select("dt", "n", value.alias("value")).repartition("dt").sortWithinPartitions("dt", "n").drop("n")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").text(root))


def read_silver(spark: SparkSession, root: str, first: _dt.date | None = None,
                last: _dt.date | None = None, mode: str = "strict") -> DataFrame:
    """Flat commit rows from silver JSON Lines; ``dt`` comes from the folder."""
    return read_days(_json_reader(spark, "lines", mode), spark, root, "json", STAGING, first, last)


def read_gold(spark: SparkSession, root: str, first: _dt.date | None = None,
              last: _dt.date | None = None) -> DataFrame:
    return read_days(spark.read, spark, root, "parquet", STAGING, first, last)
