"""Key filters of days against the full check."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hourglass.operators.checks import pk_violations
from hourglass.sources.daystore import read_days, replace_days
from hourglass.sources.key_filters import KeyFilters, day_filters

SCHEMA = "k string, dt date"
START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


@pytest.fixture
def made(spark, tmp_path):
    def make(days, bits=6):
        """Days (n -> keys) landed with their filters."""
        rows = spark.createDataFrame([(k, day(n)) for n, keys in days.items() for k in keys], SCHEMA)
        root = str(tmp_path / "t")
        schema = rows.schema
        kept = KeyFilters(spark, str(tmp_path / "f"), ["k"], lambda a, b: read_days(spark.read, spark, root, "parquet", schema, a, b), bits)
        replace_days(rows, root, "parquet", day(0), day(40))
        kept.update(day(0), day(40))
        return kept, root
    return make


def _set(df):
    return sorted((str(r.k), r.n) for r in df.collect())


@pytest.mark.parametrize("bits", [1, 6])        # one bit a key: most suspects are wrong
def test_equals_the_full_check(made, spark, bits):
    days = {n: [f"k{n}-{i}" for i in range(50 * n)] for n in range(8)}
    days[7] += [f"k{n}-{i}" for n in range(7) for i in range(0, 50 * n, 9)] + ["twice", "twice", None]
    days[3] += [None, "k7-1"]
    kept, _ = made(days, bits)
    full = pk_violations(kept.table_days(None, None), ["k"])
    assert _set(kept.violations(day(7), day(7))) == _set(full)
    suspects = kept.suspects(day(7), day(7)).count()
    hits = sum(n - 1 for k, n in _set(full) if k != "twice")
    assert suspects > hits + 50 if bits == 1 else hits <= suspects <= hits + 30


def test_only_days_of_suspects_are_read(made, spark):
    kept, root = made({n: [f"k{n}-{i}" for i in range(20)] for n in range(6)} | {9: ["k2-3", "new"]})
    days = {r.dt for r in kept.suspects(day(9), day(9)).collect()}
    assert day(2) in days and len(days) < 6
    for n in range(6):
        if day(n) not in days:      # a day that was read would fail
            folder = f"{root}/dt={day(n)}"
            for name in os.listdir(folder):
                if name.endswith(".parquet"):
                    os.remove(f"{folder}/.{name}.crc")
                    with open(f"{folder}/{name}", "wb") as out:
                        out.write(b"no parquet")
    assert _set(kept.violations(day(9), day(9))) == [("k2-3", 2)]


def test_replaced_and_emptied_days(made, spark):
    kept, root = made({0: ["a", "b"], 1: ["c"], 2: ["a", "c"]})
    assert _set(kept.violations(day(2), day(2))) == [("a", 2), ("c", 2)]
    replace_days(spark.createDataFrame([("b", day(0))], SCHEMA), root, "parquet", day(0), day(1))
    kept.update(day(0), day(1))
    assert _set(kept.violations(day(2), day(2))) == []
    assert _set(kept.violations(day(20), day(21))) == []      # no rows in the run
    replace_days(spark.createDataFrame([], SCHEMA), root, "parquet", day(0), day(2))
    kept.update(day(0), day(2))
    assert kept.filters().count() == 0 and _set(kept.violations(day(2), day(2))) == []


def test_size_and_errors(spark):
    """About one word for three keys, and few keys pass a day that lacks them."""
    rows = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("k"), F.lit(START).alias("dt"))
    words = day_filters(rows, ["k"])
    assert 5_000 * 0.95 <= words.count() <= 8_192
    from hourglass.sources import key_filters as kf
    other = spark.range(20_000, 40_000).select(F.sha1(F.col("id").cast("string")).alias("k")).withColumns({"h": kf.key_hash(["k"]), "m": kf.key_bits(["k"], kf.BITS)})
    level = words.first().level
    passed = other.withColumn("word", kf.word_of(F.col("h"), F.lit(level))).join(words, "word").where(F.col("bits").bitwiseAND(F.col("m")) == F.col("m")).count()
    assert passed <= 20_000 * 0.01
