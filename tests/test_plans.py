"""Physical-plan checks: pruning, pushdown, no global sorts, bounded broadcasts,
and every registered query against its DuckDB oracle on the smallest data."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hourglass.functions.clock import local_day_window
from hourglass.operators.ranking import rank_desc
from hourglass.plans import analytics, oracle, registry
from hourglass.plans import scenarios as sc
from hourglass.sources.events import read_events

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="driver test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_predicate_reaches_parquet(spark):
    ev = read_events(spark, SMALL).where(local_day_window(F.col("ts"), dt.date(2024, 1, 3), dt.date(2024, 1, 4)))
    plan = _plan(ev.select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(analytics.top_committers(sc.fact(spark, SMALL, "fine")))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_top_k_has_no_global_sort(spark):
    plan = _plan(analytics.top_committers(sc.fact(spark, SMALL, "fine")))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_heatmap_broadcasts_dimensions_only(spark):
    q = E.queries()["heatmap"](spark, SMALL)
    plan = _plan(q)
    assert plan.count("BroadcastExchange") >= 2
    assert "SortMergeJoin" not in plan


def test_time_is_parsed_once_per_record(spark):
    fact = sc.fact(spark, SMALL, "fine")
    assert _plan(fact).count("regexp_extract(") == 1
    assert _plan(sc.staging(spark, SMALL, "fine")).count("regexp_extract(") == 1


def test_streaks_evaluate_their_window_once(spark):
    """The query reads the exchange above the window twice, not the window."""
    df = analytics.committers_longest_streak(sc.fact(spark, SMALL, "fine"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 1
    assert plan.count("Window [") <= 2


def test_ranks_have_no_window_over_all_rows(spark):
    totals = spark.createDataFrame([(f"u{i}", 1 if i % 3 else i % 7) for i in range(400)] + [(None, 1), ("z", None)], "e string, n long")
    got = {r.e: r.r for r in rank_desc(totals, "n", ["e"]).collect()}
    values = {r.e: r.n for r in totals.collect()}
    known = [v for v in values.values() if v is not None]
    for e, v in values.items():
        assert got[e] == 1 + (sum(w > v for w in known) if v is not None else len(known))


def test_lenient_run_reads_bronze_once(spark, tmp_path, monkeypatch):
    from hourglass.plans import backfill
    from hourglass.plans.files import _land, _warehouse
    wh = _warehouse(spark, "once")
    first, last = _land(spark, SMALL, "fine", wh.bronze_path())
    reads = []
    whole = backfill.read_bronze
    monkeypatch.setattr(backfill, "read_bronze", lambda *a: reads.append(a) or whole(*a))
    res = backfill.run_days(wh, first, last, layout="lines", mode="lenient", reject_root=str(tmp_path / "r"))
    assert len(reads) == 1 and "/bronze/" not in _plan(res.rejects)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["committer_email", "sum_count", "r"] and len(rows) == 5


def _duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SMALL}/{name}')")
    return con


def _norm(v):
    return v.isoformat() if hasattr(v, "isoformat") else ("NULL" if v is None else str(v))


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_registered_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SMALL)
    cols = df.columns
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = _duck().execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in sorted(cols)]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["f_commits_hourly", "committer_totals", "top_committers",
                                  "daily_activity", "heatmap", "pk_violations"])
def test_shuffles_are_pre_aggregated(spark, name):
    """Every hash exchange over commit rows sits on a partial aggregate, so a
    committer holding a third of all commits sends at most a few rows per
    task into the shuffle, not its commits."""
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            below = lines[i + 1]
            assert "HashAggregate" in below, f"{name}: exchange without partial aggregate:\n{text}"


def test_backfill_conserves_commits(spark):
    """sum(fact.commit_count) equals the staging rows, which equal the events."""
    from hourglass.plans.files import _backfilled
    wh = _backfilled(spark, SMALL, "conserve")
    n_events = read_events(spark, SMALL).count()
    assert wh.table("staging_commits").count() == n_events
    assert wh.table("f_commits_hourly").agg(F.sum("commit_count")).first()[0] == n_events
    assert wh.table("d_date").count() == wh.table("staging_commits").select("dt").distinct().count()


def test_warehouse_analytics_and_views_plans(spark):
    """Q1-Q3 on written tables and as SQL views: top-k without a global sort,
    dimensions broadcast, the streak maximum as a one-row value."""
    from hourglass.plans.files import _backfilled
    from hourglass.plans.views import create_views
    wh = _backfilled(spark, SMALL, "planviews")
    create_views(wh)
    fact = wh.table("f_commits_hourly")
    q1 = _plan(analytics.top_committers(fact))
    assert "TakeOrderedAndProject" in q1 and "rangepartitioning" not in q1
    q3 = _plan(analytics.weekday_hour_heatmap(fact, wh.table("d_date"), wh.table("d_time")))
    assert "rangepartitioning(commit" not in q3
    v1 = _plan(spark.table(wh.name("top_committers")))
    assert "TakeOrderedAndProject" in v1 and "rangepartitioning" not in v1
    v2 = _plan(spark.table(wh.name("committer_longest_streak")))
    assert "Subquery" in v2 or "BroadcastExchange" in v2
    v3 = _plan(spark.table(wh.name("heat_map")))
    assert v3.count("HashAggregate") >= 4     # the fact is added up before it meets the dimensions


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql()) <= set(E.queries())
