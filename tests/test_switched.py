"""Isolated warehouses: readers see a day whole, old or new; a stopped run changes nothing."""

import os
import uuid

import pytest

from commit_records import D, commit, write_json
from hourglass.plans.backfill import run_days
from hourglass.sources.switched import SwitchedTable
from hourglass.sources.warehouse import Warehouse

FACT = "f_commits_hourly"


def _open(spark, root, **how):
    return Warehouse(spark, root, "t_" + uuid.uuid4().hex[:8], **how).create()


def _land(wh, days):
    for day, number in days.items():
        path = f"{wh.bronze_path()}/dt={day}/c.json"
        write_json(path, [commit(sha=f"{day}-{k}", email=f"{'ab'[k % 2]}@x", date=f"{day}T01:0{k}:00Z") for k in range(number)])


def _run(wh, first, last):
    return run_days(wh, D(first), D(last), layout="array")


def _counts(rows):
    return sorted((str(r.dt), r.committer_email, r.commit_count) for r in rows.collect())


@pytest.fixture
def wh(spark, tmp_path):
    wh = _open(spark, str(tmp_path / "w"), isolated=True)
    _land(wh, {"2024-01-01": 4, "2024-01-02": 6, "2024-01-03": 2})
    _run(wh, "2024-01-01", "2024-01-03")
    return wh


def test_same_tables_as_overwriting(spark, tmp_path, wh):
    other = _open(spark, str(tmp_path / "o"))
    _land(other, {"2024-01-01": 4, "2024-01-02": 6, "2024-01-03": 2})
    _run(other, "2024-01-01", "2024-01-03")
    for day in ("2024-01-02",):
        write_json(f"{wh.bronze_path()}/dt={day}/c.json", [])
        write_json(f"{other.bronze_path()}/dt={day}/c.json", [])
    mine, theirs = _run(wh, "2024-01-02", "2024-01-03"), _run(other, "2024-01-02", "2024-01-03")
    assert mine.days == theirs.days and mine.empty_days == theirs.empty_days
    for table in ("silver_commits", "staging_commits", "d_date", FACT):
        assert sorted(map(str, wh.table(table).collect())) == sorted(map(str, other.table(table).collect())), table
    assert sorted(map(str, spark.sql(f"SELECT * FROM {wh.name(FACT)}").collect())) == sorted(map(str, wh.table(FACT).collect()))


def test_a_read_that_has_begun_goes_on_with_the_old_rows(spark, wh):
    want = _counts(wh.table(FACT))
    pinned, begun = wh.switched(FACT).pinned(), wh.table("staging_commits").toLocalIterator()
    seen = [next(begun)]
    _land(wh, {"2024-01-01": 2, "2024-01-02": 3})
    _run(wh, "2024-01-01", "2024-01-02")
    seen += list(begun)
    assert len(seen) == 12 and _counts(pinned) == want
    new = _counts(wh.table(FACT))
    assert new == [("2024-01-01", "a@x", 1), ("2024-01-01", "b@x", 1), ("2024-01-02", "a@x", 2), ("2024-01-02", "b@x", 1),
                   ("2024-01-03", "a@x", 1), ("2024-01-03", "b@x", 1)]


def test_a_run_that_stops_before_the_switch_changes_nothing(spark, wh, monkeypatch):
    want, before = _counts(wh.table(FACT)), wh.switched(FACT).locations()
    _land(wh, {"2024-01-02": 1})
    monkeypatch.setattr(SwitchedTable, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        _run(wh, "2024-01-02", "2024-01-02")
    monkeypatch.undo()
    assert _counts(wh.table(FACT)) == want and wh.switched(FACT).locations() == before
    _run(wh, "2024-01-02", "2024-01-02")
    assert ("2024-01-02", "a@x", 1) in _counts(wh.table(FACT)) and len(_counts(wh.table(FACT))) == 5


def test_between_two_days_each_is_old_or_new(spark, wh, monkeypatch):
    table, left = wh.switched(FACT), [1]
    rows = wh.table(FACT).selectExpr("d_date_id", "d_time_id", "committer_id", "committer_email", "commit_count + 100 AS commit_count", "dt")
    run = table.write(rows, D("2024-01-01"), D("2024-01-03"))
    sql = type(spark).sql

    def once(self, text, *a, **k):
        if "ALTER" in text and not left:
            raise RuntimeError("stopped")
        left[:] = [] if "ALTER" in text else left
        return sql(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", once)
    with pytest.raises(RuntimeError):
        table.switch(run, D("2024-01-01"), D("2024-01-03"))
    monkeypatch.undo()
    spark.catalog.refreshTable(wh.name(FACT))
    states = {day: {n > 100 for d, _, n in _counts(wh.table(FACT)) if d == day} for day in ("2024-01-01", "2024-01-02", "2024-01-03")}
    assert states == {"2024-01-01": {True}, "2024-01-02": {False}, "2024-01-03": {False}}


def test_replaced_runs_are_retired(spark, wh):
    _run(wh, "2024-01-01", "2024-01-03")
    want = _counts(wh.table(FACT))
    assert wh.retire(older_than_hours=24)[FACT] == []
    assert len(wh.retire(older_than_hours=0)[FACT]) == 1 and _counts(wh.table(FACT)) == want
    assert len(os.listdir(f"{wh.path(FACT)}/runs")) == 1


def test_another_catalog_is_refused(spark, wh):
    with pytest.raises(ValueError, match="catalog"):
        _open(spark, wh.root, isolated=True)
