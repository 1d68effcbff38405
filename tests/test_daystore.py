"""Replacing days: rows are computed once."""

import datetime as dt

from pyspark.sql import functions as F

from hourglass.sources.daystore import computed_once, replace_days


def test_a_computed_day_is_computed_once_for_each_row(spark, tmp_path):
    """The range is asked of the day that was computed, and only its rows are written."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("date")
    def day(k):
        seen.add(1)
        return None if k == 7 else dt.date(2024, 1, 1 + k % 4)

    rows = spark.range(200).select("id", F.lit("x").alias("odd.`name"), day("id").alias("dt"))
    done = replace_days(rows, str(tmp_path / "t"), "parquet", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert done.days == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert seen.value == 200
    got = {r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {k for k in range(200) if k % 4 in (1, 2)}


def test_filters_do_not_repeat_the_column(spark):
    rows = spark.range(9).select("id", F.regexp_extract(F.col("id").cast("string"), "(marker)?", 1).alias("m"))
    asked = lambda df: df.where(F.col("m").between("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    assert asked(rows).count("regexp_extract") > 1 and asked(computed_once(rows)).count("regexp_extract") == 1
    assert computed_once(rows).schema.names == rows.schema.names and computed_once(rows).collect() == rows.collect()
