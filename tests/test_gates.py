"""Runs that break a limit stop, and change nothing behind the gate."""

import uuid

import pytest
from pyspark.sql import functions as F

from commit_records import D, commit, write_json
from hourglass.operators.gates import GateClosed, Gates
from hourglass.plans.backfill import run_days
from hourglass.sources.warehouse import Warehouse

FACT = "f_commits_hourly"
DAY = D("2024-01-02")
ALL = Gates(reject_share=0.25, duplicate_keys=0, orphans=0)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), "g_" + uuid.uuid4().hex[:8], isolated=True).create()


def _land(wh, records, day=DAY):
    write_json(f"{wh.bronze_path()}/dt={day}/c.json", records)


def _clean(n, **how):
    return [commit(sha=f"s{k}", email="a@x", date=f"2024-01-02T01:{k:02}:00Z", **how) for k in range(n)]


def _fact(wh):
    return sorted(map(str, wh.table(FACT).collect()))


def test_a_clean_run_passes_and_equals_one_without_gates(spark, tmp_path, wh):
    _land(wh, _clean(5))
    run_days(wh, DAY, DAY, layout="array", mode="lenient", gates=ALL)
    other = Warehouse(spark, str(tmp_path / "o"), "g_" + uuid.uuid4().hex[:8]).create()
    _land(other, _clean(5))
    run_days(other, DAY, DAY, layout="array", mode="lenient")
    assert _fact(wh) == _fact(other) and len(_fact(wh)) == 1


@pytest.mark.parametrize("records", [None, []])
def test_an_empty_run_passes(wh, records):
    if records is not None:
        _land(wh, records)
    run_days(wh, DAY, DAY, layout="array", mode="lenient", gates=ALL)
    assert _fact(wh) == []


def test_too_many_rejects_change_no_layer(wh):
    _land(wh, _clean(5))
    run_days(wh, DAY, DAY, layout="array", mode="lenient")
    before = {t: sorted(map(str, wh.table(t).collect())) for t in ("silver_commits", "staging_commits", "d_date", FACT)}
    _land(wh, _clean(7) + [commit(sha=f"bad{k}", date="no time") for k in range(3)])
    with pytest.raises(GateClosed, match="rejected"):
        run_days(wh, DAY, DAY, layout="array", mode="lenient", gates=ALL)
    assert before == {t: sorted(map(str, wh.table(t).collect())) for t in before}
    run_days(wh, DAY, DAY, layout="array", mode="lenient", gates=Gates(reject_share=0.3))
    assert wh.table("staging_commits").count() == 7


@pytest.mark.parametrize("other", [7, None])
def test_a_key_with_two_ids_leaves_the_fact(wh, other):
    _land(wh, _clean(3, committer={"id": 5}))
    run_days(wh, DAY, DAY, layout="array", gates=Gates(duplicate_keys=0))
    before = _fact(wh)
    _land(wh, _clean(3, committer={"id": 5}) + [commit(sha="t", email="a@x", date="2024-01-02T01:30:00Z", committer={"id": other} if other else None)])
    with pytest.raises(GateClosed, match="several"):
        run_days(wh, DAY, DAY, layout="array", gates=Gates(duplicate_keys=0))
    assert _fact(wh) == before
    run_days(wh, DAY, DAY, layout="array", gates=Gates(duplicate_keys=1))
    assert wh.table(FACT).agg(F.sum("commit_count")).first()[0] == 4


def test_an_hour_without_a_row_leaves_the_fact(wh):
    _land(wh, _clean(3))
    hours = wh.table("d_time").where("d_time_id != 8").collect()
    wh.spark.createDataFrame(hours, wh.table("d_time").schema).write.mode("overwrite").parquet(wh.path("d_time"))
    wh.spark.catalog.refreshTable(wh.name("d_time"))
    with pytest.raises(GateClosed, match="hour"):
        run_days(wh, DAY, DAY, layout="array", gates=ALL)
    assert _fact(wh) == []


def test_gates_on_the_fact_need_isolation(spark, tmp_path):
    plain = Warehouse(spark, str(tmp_path / "p"), "g_" + uuid.uuid4().hex[:8]).create()
    with pytest.raises(ValueError, match="isolated"):
        run_days(plain, DAY, DAY, gates=Gates(orphans=0))


def test_gates_read_nothing_again(spark, wh):
    """One more job in a gated run: the hours of d_time.  The rest is counted by the writes."""
    _land(wh, _clean(5))
    run_days(wh, DAY, DAY, layout="array", mode="lenient")      # both runs below replace the same days
    jobs = {}
    for name, gates in (("open", None), ("gated", ALL)):
        group = name + uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, name)
        run_days(wh, DAY, DAY, layout="array", mode="lenient", gates=gates)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert 0 < jobs["open"] and jobs["gated"] - jobs["open"] <= 2     # distinct hours: a shuffle and a result job
