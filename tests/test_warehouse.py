"""Range runs over files: empty days (T5), re-runs, ranges, guard, streaming."""

import datetime as dt
import os
import subprocess
import sys
import uuid

import pytest

from commit_records import D, commit, write_json
from hourglass.plans.backfill import run_days
from hourglass.sources.warehouse import Warehouse
from hourglass.streaming import contiguous_ranges, start_bronze_trigger


def _wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), "t_" + uuid.uuid4().hex[:8]).create()


def _land(wh, day, records, name="commits.json"):
    write_json(f"{wh.bronze_path()}/dt={day}/{name}", records)


def _snapshot(wh):
    out = {}
    for t in ("staging_commits", "d_date", "f_commits_hourly", "silver_commits"):
        out[t] = sorted(tuple(r) for r in wh.table(t).collect())
    return out


def _day_commits(day, n, email="a@x"):
    d = D(day) - dt.timedelta(days=1)
    return [commit(f"{day}-{i}", {"id": i % 3}, email=email,
                   date=f"{d.isoformat()}T{17 + i % 7:02d}:00:0{i % 10}Z") for i in range(n)]


def test_d_time_created_once(spark, tmp_path):
    wh = _wh(spark, tmp_path)
    assert wh.table("d_time").count() == 24
    wh.create()
    assert wh.table("d_time").count() == 24


def test_run_rerun_and_empty_day(spark, tmp_path):
    wh = _wh(spark, tmp_path)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        _land(wh, day, _day_commits(day, 5))
    res = run_days(wh, D("2024-01-01"), D("2024-01-03"))
    assert len(res.days["staging_commits"]) == 3 and res.empty_days["d_date"] == []
    first = _snapshot(wh)
    assert len(first["staging_commits"]) == 15
    assert sum(r[4] for r in first["f_commits_hourly"]) == 15        # sum(count) = staging rows
    assert len(first["d_date"]) == 3
    run_days(wh, D("2024-01-01"), D("2024-01-03"))                    # same run twice = once
    assert _snapshot(wh) == first
    for t in ("silver_commits", "staging_commits", "d_date", "f_commits_hourly"):   # no small files
        for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
            files = [f for f in os.listdir(f"{wh.path(t)}/dt={day}") if not f.startswith((".", "_"))]
            assert len(files) == 1, (t, day, files)
    # the day is re-extracted and now holds no commits: every layer drops it (T5)
    _land(wh, "2024-01-02", [])
    res = run_days(wh, D("2024-01-02"), D("2024-01-02"))
    after = _snapshot(wh)
    assert D("2024-01-02") in res.empty_days["f_commits_hourly"]
    for t, rows in after.items():
        assert all(r[-1] != D("2024-01-02") for r in rows), t
    assert len(after["staging_commits"]) == 10 and len(after["d_date"]) == 2


def test_inverted_range_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        run_days(_wh(spark, tmp_path), D("2024-01-03"), D("2024-01-01"))


def test_range_equals_days(spark, tmp_path):
    a, b = _wh(spark, tmp_path / "a"), _wh(spark, tmp_path / "b")
    for wh in (a, b):
        for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
            _land(wh, day, _day_commits(day, 3 + i, email=f"{i % 2}@x"))
    run_days(a, D("2024-01-01"), D("2024-01-03"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        run_days(b, D(day), D(day))
    assert _snapshot(a) == _snapshot(b)


def test_guard_strict_and_lenient(spark, tmp_path):
    wh = _wh(spark, tmp_path)
    recs = _day_commits("2024-01-05", 2) + [commit("late", {"id": 1}, date="2024-01-05T18:00:00Z")]
    _land(wh, "2024-01-05", recs)
    with pytest.raises(Exception, match="wrong day folder"):
        run_days(wh, D("2024-01-05"), D("2024-01-05"))
    res = run_days(wh, D("2024-01-05"), D("2024-01-05"), mode="lenient",
                   reject_root=str(tmp_path / "rejects"))
    assert [r.commit_sha for r in res.rejects.collect()] == ["late"]
    assert wh.table("staging_commits").count() == 2


def test_streaming_trigger(spark, tmp_path):
    assert contiguous_ranges([D("2024-01-03"), D("2024-01-01"), D("2024-01-02"), D("2024-01-07")]) == [
        (D("2024-01-01"), D("2024-01-03")), (D("2024-01-07"), D("2024-01-07"))]
    wh = _wh(spark, tmp_path)
    _land(wh, "2024-01-01", _day_commits("2024-01-01", 4))
    q = start_bronze_trigger(wh, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert wh.table("f_commits_hourly").groupBy().sum("commit_count").first()[0] == 4
    # a new page for the same day re-runs that day with both files
    _land(wh, "2024-01-01", _day_commits("2024-01-01", 2, email="b@x")[:1], name="page2.json")
    q = start_bronze_trigger(wh, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert wh.table("staging_commits").count() == 5


def test_sql_views_equal_dataframe_plans(spark, tmp_path):
    from hourglass.operators.dims import d_time
    from hourglass.plans import analytics
    from hourglass.plans.views import create_views
    wh = _wh(spark, tmp_path)
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05")):
        _land(wh, day, _day_commits(day, 4 + i, email=f"{i % 3}@x") + _day_commits(day, 2, email="z@x"))
    run_days(wh, D("2024-01-01"), D("2024-01-05"))
    names = create_views(wh)
    fact, dd = wh.table("f_commits_hourly"), wh.table("d_date")

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    def view(n):
        return spark.table(wh.name(n))
    assert rows(view("top_committers")) == rows(analytics.top_committers(fact))
    assert rows(view("committer_longest_streak")) == rows(analytics.committers_longest_streak(fact))
    assert rows(view("heat_map")) == rows(analytics.weekday_hour_heatmap(fact, dd, wh.table("d_time")))
    assert rows(view("heat_map_distinct")) == rows(
        analytics.weekday_hour_heatmap(fact, dd, d_time(spark, "3h"), distinct_first=True))
    assert len(names) == 4


def test_command_line_run(spark, tmp_path):
    from hourglass.__main__ import main
    root = str(tmp_path / "cli")
    write_json(f"{root}/bronze/commits/dt=2024-01-04/commits.json", _day_commits("2024-01-04", 3))
    assert main(["run", "--root", root, "--db", "cli_db", "--first", "2024-01-04",
                 "--last", "2024-01-05", "--layout", "array"]) == 0
    wh = Warehouse(spark, root, "cli_db")
    assert wh.table("f_commits_hourly").groupBy().sum("commit_count").first()[0] == 3
    with pytest.raises(SystemExit):       # views would end with this process
        main(["views", "--root", root, "--db", "cli_db"])


def test_literal_hour_labels_in_warehouse(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "lit"), "t_" + uuid.uuid4().hex[:8], d_time_variant="literal").create()
    labels = {r.d_time_id: r.hour_range_str for r in wh.table("d_time").collect()}
    assert labels[2] == "02-04" and labels[0] == "22-00" and len(labels) == 24


PROCESS = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from commit_records import D
from test_warehouse import _day_commits
from hourglass.session import get_session
from hourglass.plans.backfill import run_days
from hourglass.sources.warehouse import Warehouse
from commit_records import write_json
spark = get_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {root!r} + "/ckpt"}})
wh = Warehouse(spark, {root!r}, "two").create()
for day in {days!r}:
    rows = _day_commits(day, 4)
    for r in rows:
        r["committer"] = {{"id": {number}}}
    write_json(wh.bronze_path() + f"/dt={{day}}/commits.json", rows)
run_days(wh, D({days!r}[0]), D({days!r}[-1]))
fact = wh.table("f_commits_hourly")
sql = spark.table(wh.name("f_commits_hourly"))
print("FACT", sorted((str(r.dt), r.committer_id) for r in fact.select("dt", "committer_id").distinct().collect()),
      fact.count() == sql.count())
"""


def test_two_processes_share_a_warehouse(tmp_path):
    """The second process sees the first one's days, and its merge keeps their ids."""
    tests = os.path.dirname(os.path.abspath(__file__))
    out = []
    for days, number in ((["2024-01-02", "2024-01-03"], 1), (["2024-01-02"], 9)):
        code = PROCESS.format(repo=os.path.dirname(tests), tests=tests, root=str(tmp_path / "wh"), days=days, number=number)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        out.append([x for x in done.stdout.splitlines() if x.startswith("FACT")] or [done.stderr[-2000:]])
    assert out[0] == out[1] == ["FACT [('2024-01-02', 1), ('2024-01-03', 1)] True"]


def test_a_failed_write_or_listing_removes_nothing(spark, tmp_path, monkeypatch):
    from hourglass.sources import daystore
    wh = _wh(spark, tmp_path)
    for day in ("2024-01-01", "2024-01-02"):
        _land(wh, day, _day_commits(day, 3))
    run_days(wh, D("2024-01-01"), D("2024-01-02"))
    before = _snapshot(wh)
    whole = daystore._files
    calls = []

    def failing(*args):
        calls.append(args)
        if len(calls) % 2 == 0:     # the listing after the write
            raise OSError("listing failed")
        return whole(*args)

    monkeypatch.setattr(daystore, "_files", failing)
    with pytest.raises(OSError):
        run_days(wh, D("2024-01-01"), D("2024-01-02"))
    monkeypatch.undo()
    assert _snapshot(wh) == before
    _land(wh, "2024-01-02", [commit("x", {"id": 1}, date="not a date")])
    with pytest.raises(Exception):
        run_days(wh, D("2024-01-01"), D("2024-01-02"))
    assert _snapshot(wh) == before


def test_rejects_follow_a_corrected_file(spark, tmp_path):
    wh, rejects = _wh(spark, tmp_path), str(tmp_path / "rejects")
    _land(wh, "2024-01-05", _day_commits("2024-01-05", 2) + [commit("bad", {"id": 1}, date="2024")])
    _land(wh, "2024-01-06", _day_commits("2024-01-06", 1) + [commit("worse", {"id": 1}, date="2024")])
    args = {"mode": "lenient", "reject_root": rejects}
    run_days(wh, D("2024-01-05"), D("2024-01-06"), **args)

    def rejected():
        return sorted(r.commit_sha for r in spark.read.schema("commit_sha string").json(rejects).collect())
    assert rejected() == ["bad", "worse"]
    _land(wh, "2024-01-05", _day_commits("2024-01-05", 3))
    run_days(wh, D("2024-01-05"), D("2024-01-05"), **args)
    assert rejected() == ["worse"] and wh.table("staging_commits").count() == 4


def test_pages_become_one_file_per_day(spark, tmp_path):
    wh = _wh(spark, tmp_path)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        for page in range(12):
            _land(wh, day, [dict(c, sha=f"{day}-{page}-{c['sha']}") for c in _day_commits(day, 3)], name=f"p{page}.json")
    run_days(wh, D("2024-01-01"), D("2024-01-03"))
    assert wh.table("staging_commits").count() == 108
    for t in ("silver_commits", "staging_commits"):
        for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
            assert len([f for f in os.listdir(f"{wh.path(t)}/dt={day}") if f.startswith("part-")]) == 1


def test_a_read_lists_its_own_days_only(spark, tmp_path):
    from hourglass.sources.landed import read_bronze
    wh = _wh(spark, tmp_path)
    for k in range(1, 8):
        _land(wh, f"2024-01-0{k}", _day_commits(f"2024-01-0{k}", 2))
    os.makedirs(f"{wh.bronze_path()}/dt=2024-01-02_old")
    _land(wh, "2024-01-02_old", _day_commits("2024-01-02", 2))
    assert len(read_bronze(spark, wh.bronze_path(), D("2024-01-02"), D("2024-01-02")).inputFiles()) == 1
    assert len(read_bronze(spark, wh.bronze_path()).inputFiles()) == 7


def test_trigger_sees_emptied_and_overwritten_days(spark, tmp_path):
    wh = _wh(spark, tmp_path)
    for day in ("2024-01-01", "2024-01-02"):
        _land(wh, day, _day_commits(day, 4))

    def trigger():
        start_bronze_trigger(wh, str(tmp_path / "ckpt"), available_now=True).awaitTermination(120)
        return {str(r.dt): r["count"] for r in wh.table("staging_commits").groupBy("dt").count().collect()}
    assert trigger() == {"2024-01-01": 4, "2024-01-02": 4}
    _land(wh, "2024-01-01", [])                                     # re-landed without commits
    _land(wh, "2024-01-02", _day_commits("2024-01-02", 6))          # overwritten under the same name
    assert trigger() == {"2024-01-02": 6}
    _land(wh, "2024-01-03", [])
    assert trigger() == {"2024-01-02": 6}
    os.remove(f"{wh.bronze_path()}/dt=2024-01-02/commits.json")
    assert trigger() == {}
