"""Declared keys checked against all history by a run that reads little of it.

Beside each day of a table lies a Bloom filter of its keys: words of 64 bits, a
key setting ``BITS`` bits of the one word that its hash names.  A day has a
power of two of words, its ``level``, so that two to four keys share one.  The
filters are rows (dt, level, word, bits) in day folders of their own, about
one for three keys, and are made again for the days that a run replaces.

A run then probes only its own keys against the filters of the other days:
one row per key and level, of which there are at most some dozens, joined with
the filters on (level, word) and kept where all bits are set.  What passes is a
key and a day that may hold it.  Only those days are read, and only their rows
whose key passed are counted, so the filter's errors cost reads and never rows.
At ``BITS`` = 6 about one key in two hundred passes a day that lacks it.

NULL keys are keys like any other (they group together, as in
``checks.pk_violations``).  A key that no row of the run has is not looked at:
the runs that brought it did so.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from hourglass.operators.checks import pk_violations
from hourglass.session import scratch_path
from hourglass.sources.daystore import DayWrite, read_days, replace_days

BITS = 6
FILTER = StructType([StructField("level", IntegerType()), StructField("word", LongType()), StructField("bits", LongType()), StructField("dt", DateType())])


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def key_bits(keys: list[str], bits: int) -> Column:
    """The bits that a key sets in its word: ``bits`` times six bits of a second hash."""
    drawn = F.xxhash64(F.lit(1), *keys)
    places = [F.shiftrightunsigned(drawn, 6 * k).bitwiseAND(63).cast("int") for k in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def word_of(hashed: Column, level: Column) -> Column:
    """The lowest ``level`` bits of the hash."""
    return hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)


def day_filters(rows: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """(level, word, bits, dt) of the rows' keys.  A day's level comes from its
    rows, so a day with many repeated keys gets more words than it needs."""
    sizes = rows.groupBy("dt").agg(F.greatest(F.ceil(F.log2(F.count(F.lit(1)) / 4)), F.lit(0)).cast("int").alias("level"))
    set_bits = rows.select("dt", key_hash(keys).alias("h"), key_bits(keys, bits).alias("m")).join(sizes, "dt")
    return (set_bits.groupBy("dt", "level", word_of(F.col("h"), F.col("level")).alias("word"))
            .agg(F.bit_or("m").alias("bits")).select(*FILTER.names))


class KeyFilters:
    """Filters below ``root`` for ``keys`` of a table whose days ``table_days(first, last)`` reads."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str] | tuple[str, ...],
                 table_days: Callable[[_dt.date | None, _dt.date | None], DataFrame], bits: int = BITS):
        self.spark, self.root, self.keys, self.table_days, self.bits = spark, root, list(keys), table_days, bits

    def update(self, first: _dt.date, last: _dt.date) -> DayWrite:
        """Make the filters of days first..last anew; those of days without rows are removed."""
        return replace_days(day_filters(self.table_days(first, last), self.keys, self.bits), self.root, "parquet", first, last)

    def filters(self) -> DataFrame:
        return read_days(self.spark.read, self.spark, self.root, "parquet", FILTER)

    def suspects(self, first: _dt.date, last: _dt.date) -> DataFrame:
        """(keys, day outside first..last whose filter has the key), keys of days first..last."""
        others = self.filters().where(~F.col("dt").between(F.lit(first), F.lit(last)))
        levels = [r["level"] for r in others.select("level").distinct().collect()]      # at most one for each power of two
        own = self.table_days(first, last).select(*self.keys).distinct()
        asked = own.withColumns({"h": key_hash(self.keys), "m": key_bits(self.keys, self.bits)})
        asked = asked.withColumn("level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("word", word_of(F.col("h"), F.col("level")))
        return (asked.join(others, ["level", "word"]).where(F.col("bits").bitwiseAND(F.col("m")) == F.col("m"))
                .select(*self.keys, "dt"))

    def violations(self, first: _dt.date, last: _dt.date) -> DataFrame:
        """Keys of days first..last that the table holds more than once: keys + ``n``."""
        held = scratch_path(self.spark, "suspects")
        found = self.suspects(first, last)
        found.write.parquet(held)
        found = self.spark.read.schema(found.schema).parquet(held)
        rows = self.table_days(first, last).select(*self.keys)
        days = [r["dt"] for r in found.select("dt").distinct().collect()]       # day names, each at most once
        if days:
            old = self.table_days(min(days), max(days)).where(F.col("dt").isin(days))       # a partition filter
            same = [old[k].eqNullSafe(found[k]) for k in self.keys] + [old["dt"] == found["dt"]]
            rows = rows.union(old.join(found, reduce(lambda x, y: x & y, same), "left_semi").select(*self.keys))
        return pk_violations(rows, self.keys)
