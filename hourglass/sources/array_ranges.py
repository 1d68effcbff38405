"""One big JSON array per file, parsed in byte ranges.

Spark's text source splits a file anywhere if it is told where lines end.
Here a line ends at ``}``, so a range yields the pieces between closing braces;
a piece that a cut falls into belongs to the range in which it begins.

What a piece does depends on two things only: whether it starts inside a
string, and how deep.  So each piece is a map: does it leave the other side of
a quote, and how does the depth change if it starts outside, and if inside.
These maps compose.  A window over each range composes the pieces for either
start; one row per range is left, and a window over a file's ranges composes
those, which gives the true start of every range.  Then a ``}`` outside of
strings that leads from depth 2 to depth 1 ends a record.

Records inside a range are put together there; only the first and last
fragment of each range are shuffled to meet their other half.  Tasks hold a
range or a record, never a file.  The text is shuffled once; the passes
that find the range starts move a few numbers per piece.

A file must be an array of objects.  Strict mode fails on any other, on text
between records beyond one comma, and on a record that does not parse.
Lenient mode gives a row with the corrupt text for a record that does not
parse or follows other text, and one row naming the file where quotes or
brackets do not close.  Empty files and arrays give no rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from hourglass.sources.daystore import existing_days, read_days

_PIECE = StructType([StructField("value", StringType()), StructField("dt", DateType())])
_RANGE = ("file", "start")


def _pieces(spark: SparkSession, root: str, first: _dt.date | None, last: _dt.date | None, file_glob: str) -> DataFrame:
    """value, dt, file, start (of the range), at (order within the range)."""
    if not existing_days(spark, root, first, last):
        return spark.createDataFrame([], "value string, dt date, file string, start long, at long")
    reader = spark.read.option("lineSep", "}").option("pathGlobFilter", file_glob)
    read = read_days(reader, spark, root, "text", _PIECE, first, last)
    return read.select("value", "dt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("at"))


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _mapped(pieces: DataFrame) -> DataFrame:
    """Each piece's map: ``flip``, and the change of depth if it starts outside (``if_out``) or inside (``if_in``) a string."""
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    side = lambda odd: F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
    depth = lambda text: _count(text, "{[") - _count(text, "]")
    order = Window.partitionBy(*_RANGE).orderBy("at")
    # Each piece but the file's first stands behind a brace.
    brace = F.when((F.col("start") == 0) & (F.row_number().over(order) == 1), 0).otherwise(1)
    out = pieces.withColumns({"flip": (F.size(parts) - 1) % 2, "d_out": depth(side(0)), "if_in": depth(side(1)), "brace": brace})
    return out.withColumn("if_out", F.col("d_out") - F.col("brace")).drop("d_out")


def _placed(mapped: DataFrame) -> DataFrame:
    """``inside``: whether a piece starts in a string if its range does not;
    ``deep_0`` and ``deep_1``: its depth against the range's start, if the range starts outside or inside a string."""
    before = Window.partitionBy(*_RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    out = mapped.withColumn("inside", total("flip") % 2)
    out = out.withColumn("step_0", F.when(F.col("inside") == 0, F.col("if_out")).otherwise(F.col("if_in")))
    out = out.withColumn("step_1", F.when(F.col("inside") == 1, F.col("if_out")).otherwise(F.col("if_in")))
    return out.withColumns({"deep_0": total("step_0"), "deep_1": total("step_1")})


def _ranges(placed: DataFrame, strict: bool) -> DataFrame:
    """One row per range: ``from_in`` and ``from_deep``, its true start;
    ``records``, those that end in it, and ``earlier``, those that end before it;
    ``all_records`` of the file, and ``broken``: quotes or brackets do not close.

    A piece's brace is outside of strings for just one of the two starts, so
    counts by depth for that start tell how many records end, whatever the true one is."""
    event = placed.withColumn("deep", F.when(F.col("inside") == 0, F.col("deep_0")).otherwise(F.col("deep_1")))
    sums = [F.sum(c).alias(c) for c in ("flip", "step_0", "step_1")]
    found = event.groupBy(*_RANGE, "inside", "deep").agg(F.sum("brace").alias("braces"), *sums)
    found = found.groupBy(*_RANGE).agg(F.collect_list(F.struct("inside", "deep", "braces")).alias("events"), *sums)
    order = Window.partitionBy("file").orderBy("start")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    found = found.withColumn("from_in", total("flip") % 2)
    found = found.withColumn("step", F.when(F.col("from_in") == 0, F.col("step_0")).otherwise(F.col("step_1")))
    found = found.withColumn("from_deep", total("step"))
    ending = F.filter("events", lambda e: (e["inside"] == F.col("from_in")) & (e["deep"] + F.col("from_deep") == 2))
    found = found.withColumn("records", F.aggregate(ending, F.lit(0).cast("long"), lambda n, e: n + e["braces"]))
    broken = (F.sum("flip").over(whole) % 2 != 0) | (F.sum("step").over(whole) != 0)
    found = found.withColumns({"earlier": total("records"), "all_records": F.sum("records").over(whole), "broken": broken})
    found = found.select(*_RANGE, "from_in", "from_deep", "records", "earlier", "all_records", "broken")
    if strict:
        message = F.concat(F.lit("not a JSON array whose quotes and brackets close: "), F.col("file"))
        found = found.withColumn("broken", F.when(F.col("broken"), F.raise_error(message).cast("boolean")).otherwise(F.lit(False)))
    return found


def read_array_ranges(spark: SparkSession, root: str, schema: StructType, first: _dt.date | None = None,
                      last: _dt.date | None = None, mode: str = "strict", file_glob: str = "*.json",
                      corrupt: str = "_corrupt_record") -> DataFrame:
    """Rows of ``schema`` and ``dt`` from the array files of days first..last;
    in lenient mode ``schema`` has the string column ``corrupt``."""
    strict = mode == "strict"
    placed = _placed(_mapped(_pieces(spark, root, first, last, file_glob)))
    ranges = _ranges(placed.drop("value"), strict)
    rows = placed.join(ranges, list(_RANGE))
    deep = F.when(F.col("from_in") == 0, F.col("deep_0")).otherwise(F.col("deep_1")) + F.col("from_deep")
    ends = (F.col("inside") == F.col("from_in")) & (F.col("brace") == 1) & (deep == 2)
    order = Window.partitionBy(*_RANGE).orderBy("at")
    rows = rows.where(~F.col("broken")).withColumn("own", F.sum(ends.cast("long")).over(order))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), "}")
    parts = rows.groupBy(*_RANGE, "own", "records", "earlier", "all_records", "dt").agg(text.alias("text"))
    parts = parts.withColumn("number", F.col("earlier") + F.col("own"))

    inner = parts.where((F.col("own") > 0) & (F.col("own") < F.col("records"))).select("file", "number", "all_records", "dt", "text")
    border = parts.where((F.col("own") == 0) | (F.col("own") == F.col("records")))
    border = border.groupBy("file", "number", "all_records", "dt").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
    border = border.withColumn("text", F.array_join(F.transform("parts", lambda p: p["text"]), "}")).drop("parts")
    found = inner.unionByName(border.select(*inner.columns))

    # Before the first record an opening bracket, before the others a comma, behind the last the closing bracket.
    lead = F.when(F.col("number") == 0, r"^\s*\[\s*").otherwise(r"^\s*,\s*")
    tail = F.col("number") == F.col("all_records")
    tail_ok = F.col("text").rlike(r"^\s*\]\s*$") & (F.col("number") > 0) | F.col("text").rlike(r"^\s*\[\s*\]\s*$") & (F.col("number") == 0)
    blank = F.col("text").rlike(r"^\s*$") & (F.col("all_records") == 0)
    good = F.when(tail, tail_ok | blank).otherwise(F.regexp_like("text", F.concat(lead, F.lit(r"\{"))))
    found = found.withColumn("good", good).where(~(tail & F.col("good")))
    record = F.concat(F.regexp_replace(F.col("text"), lead, F.lit("")), F.lit("}"))
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = schema if strict else StructType([f for f in schema.fields if f.name != corrupt] + [StructField(corrupt, StringType())])
    if strict:
        message = F.concat(F.lit("text between the records of a JSON array: "), F.col("file"))
        record = F.when(F.col("good"), record).otherwise(F.raise_error(message))
        return found.select(F.from_json(record, parsed, options).alias("r"), "dt").select("r.*", "dt")
    options["columnNameOfCorruptRecord"] = corrupt
    rows = found.select(F.when(F.col("good"), F.from_json(record, parsed, options)).alias("r"), "good", "text", "dt")
    kept = [F.col(f"r.`{f.name}`").alias(f.name) if f.name != corrupt else
            F.when(F.col("good"), F.col(f"r.`{corrupt}`")).otherwise(F.col("text")).alias(corrupt) for f in schema.fields]
    days = placed.select("file", "dt").distinct()
    broken = ranges.where("broken").select("file").distinct().join(days, "file")
    lost = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != corrupt else F.col("file").alias(corrupt) for f in schema.fields]
    return rows.select(*kept, "dt").unionByName(broken.select(*lost, "dt"))
