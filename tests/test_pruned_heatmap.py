"""The heat map of chosen dates reads only their days of the fact."""

import os

from pyspark.sql import functions as F

from commit_records import D
from hourglass.operators.dims import d_date_rows, d_time
from hourglass.operators.heatmap import heatmap
from hourglass.sources.daystore import read_days, replace_days
from hourglass.sources.schemas import D_DATE, F_COMMITS_HOURLY

FIRST, LAST = D("2024-01-01"), D("2024-01-28")


def _tables(spark, root):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-28')) AS dt")
    dates = d_date_rows(days.where("day(dt) != 13"))       # one Saturday has no date row
    fact = days.crossJoin(spark.range(24)).selectExpr(
        "CAST(date_format(dt, 'yyyyMMdd') AS BIGINT) AS d_date_id", "id AS d_time_id", "1L AS committer_id",
        "concat('e', id % 3) AS committer_email", "day(dt) + id AS commit_count", "dt")
    for rows, name in ((dates, "d"), (fact, "f")):
        replace_days(rows, f"{root}/{name}", "parquet", FIRST, LAST)
    return (read_days(spark.read, spark, f"{root}/f", "parquet", F_COMMITS_HOURLY), read_days(spark.read, spark, f"{root}/d", "parquet", D_DATE))


def test_chosen_dates(spark, tmp_path):
    fact, dates = _tables(spark, str(tmp_path))
    for distinct in (False, True):
        got = heatmap(fact, dates, d_time(spark), distinct, dates=F.col("weekday_number") >= 6).collect()
        want = [r for r in heatmap(fact, dates, d_time(spark), distinct).collect() if r.weekday in ("Saturday", "Sunday")]
        assert got == want and len(got) == 2
    assert heatmap(fact, dates, d_time(spark), dates=F.lit(False)).collect() == []


def test_the_plan_prunes_and_other_days_stay_closed(spark, tmp_path):
    fact, dates = _tables(spark, str(tmp_path))
    weekend = heatmap(fact, dates, d_time(spark), dates=F.col("weekday_number") >= 6)
    before = weekend.collect()
    plan = weekend._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(dt" in plan and "dynamicpruningexpression(true)" not in plan
    for k in range(1, 29):
        folder = f"{tmp_path}/f/dt=2024-01-{k:02}"
        if D(f"2024-01-{k:02}").isoweekday() < 6:      # a file that was opened would fail
            for name in os.listdir(folder):
                if name.endswith(".parquet"):
                    os.remove(f"{folder}/.{name}.crc")
                    with open(f"{folder}/{name}", "wb") as out:
                        out.write(b"no parquet")
    assert heatmap(fact, dates, d_time(spark), dates=F.col("weekday_number") >= 6).collect() == before
