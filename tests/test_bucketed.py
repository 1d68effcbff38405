"""The fact in buckets of its merge key: the same merges, without dealing the target out."""

import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from commit_records import D
from hourglass.operators.merge import merge_fact_table
from hourglass.sources.bucketed import BucketedFact
from hourglass.sources.schemas import F_COMMITS_HOURLY, FACT_MERGE_KEY

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def _rows(spark, rows):
    return spark.createDataFrame([(int(d.replace("-", "")), h, i, e, n, D(d)) for d, h, i, e, n in rows], F_COMMITS_HOURLY)


def _old(spark):
    return _rows(spark, [(d, h, 1, e, 10 + h) for d in DAYS[:3] for h in (1, 2) for e in ("a", "b", None)])


def _new(spark):
    return _rows(spark, [("2024-01-02", 1, 7, "a", 3), ("2024-01-02", 1, 8, "a", 4), ("2024-01-02", 5, 7, None, 1), ("2024-01-04", 1, 7, "c", 2)])


def _plain(rows):
    return sorted(map(str, rows.collect()))


@pytest.fixture
def fact(spark, tmp_path):
    name = "b_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return BucketedFact(spark, f"{name}.fact", str(tmp_path / "fact"), 8).create()


def test_same_rows_as_the_merge_on_days(spark, fact):
    fact.replace_days(_old(spark), D(DAYS[0]), D(DAYS[3]))
    assert _plain(fact.table()) == _plain(_old(spark))
    done = fact.merge(_new(spark), D(DAYS[1]), D(DAYS[3]))
    assert _plain(fact.table()) == _plain(merge_fact_table(_old(spark), _new(spark), D(DAYS[1]), D(DAYS[3])))
    assert done.days == [D(DAYS[1]), D(DAYS[3])] and done.empty_days == [D(DAYS[2])]
    assert not os.path.exists(f"{fact.root}/dt={DAYS[2]}")
    fact.merge(_new(spark), D(DAYS[1]), D(DAYS[3]))  # again: nothing changes but the ids of NULL emails, which never match
    assert _plain(fact.table()) == _plain(merge_fact_table(_old(spark), _new(spark), D(DAYS[1]), D(DAYS[3])))
    fact.merge(_new(spark).limit(0), D(DAYS[0]), D(DAYS[3]))
    assert fact.table().count() == 0


def test_the_target_is_not_dealt_out(spark, fact):
    fact.replace_days(_old(spark), D(DAYS[0]), D(DAYS[3]))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = _new(spark).withColumn("commit_count", F.col("commit_count") + 1)
        plan = fact.merged(source, D(DAYS[1]), D(DAYS[3]), delete_zero=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if "FileScan parquet" in line)
    depth = lambda line: len(re.match(r"[ :|+\-*]*", line)[0])
    above, held = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < held:
            held = depth(line)
            above.append(line)
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above), plan
    assert "Bucketed: true" in lines[at] and plan.count("Exchange") == 1


def test_one_file_per_day_and_bucket(spark, fact):
    rows = _old(spark).repartition(8, *FACT_MERGE_KEY)
    fact.replace_days(rows, D(DAYS[0]), D(DAYS[3]))
    for day in DAYS[:3]:
        files = [f for f in os.listdir(f"{fact.root}/dt={day}") if f.endswith(".parquet")]
        assert len(files) == len({re.search(r"_(\d{5})\.c", f)[1] for f in files}) <= 6
