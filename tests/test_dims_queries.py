"""Dimensions (D1-D3) and the analyst queries (Q1-Q7)."""

from commit_records import D
from hourglass.functions.clock import HOUR_RANGE_LABELS
from hourglass.operators.dims import d_date_rows, d_time
from hourglass.operators.heatmap import heatmap
from hourglass.operators.ranking import rank_desc
from hourglass.operators.streaks import (daily_activity, longest_streak, longest_streak_from_lengths,
                                         streak_boundaries, streak_groups, streak_lengths)
from hourglass.plans.analytics import committer_rank, top_committers
from hourglass.sources.schemas import F_COMMITS_HOURLY



def _by_stages(fact):
    return longest_streak_from_lengths(streak_lengths(streak_groups(streak_boundaries(daily_activity(fact)))))


def _labels(spark, variant):
    return {r.d_time_id: r.hour_range_str for r in d_time(spark, variant).collect()}


def test_d_time_3h(spark):
    got = _labels(spark, "3h")
    assert got[0] == got[22] == got[23] == "22-00"
    assert [got[h] for h in (1, 2, 3)] == ["01-03"] * 3
    assert [got[h] for h in (19, 20, 21)] == ["19-21"] * 3
    assert set(got.values()) == set(HOUR_RANGE_LABELS) and len(got) == 24


def test_d_time_literal(spark):
    got = _labels(spark, "literal")
    assert got[0] == "22-00" and got[1] == "01-03" and got[2] == "02-04"
    assert got[22] == "22-24" and got[23] == "23-25"


def test_d_date_rows(spark):
    days = spark.createDataFrame([(D("2024-01-07"),), (D("2024-01-08"),), (D("2024-01-08"),)], "dt date")
    got = {r.dt: r for r in d_date_rows(days).collect()}
    assert len(got) == 2
    sun, mon = got[D("2024-01-07")], got[D("2024-01-08")]
    assert (sun.weekday, sun.weekday_number, sun.d_date_id, sun.date_str) == ("Sunday", 7, 20240107, "2024-01-07")
    assert (mon.weekday, mon.weekday_number, mon.d_date_id) == ("Monday", 1, 20240108)


def _fact(spark, rows):
    """rows: (email, 'YYYY-MM-DD', hour, count)"""
    data = []
    for email, day, hour, count in rows:
        d = D(day)
        data.append((int(d.strftime("%Y%m%d")), hour, 1, email, count, d))
    return spark.createDataFrame(data, F_COMMITS_HOURLY)


def test_top_committers_ties(spark):
    """Q1: sums 9,7,7,5,4,4 -> ranks 1,2,2,4,5; the cut decided by email."""
    sums = {"a": 9, "b": 7, "c": 7, "d": 5, "f": 4, "e": 4}
    fact = _fact(spark, [(k, "2024-01-01", 1, v) for k, v in sums.items()])
    got = [(r.committer_email, r.sum_count, r.r) for r in top_committers(fact).orderBy("r", "committer_email").collect()]
    assert got == [("a", 9, 1), ("b", 7, 2), ("c", 7, 2), ("d", 5, 4), ("e", 4, 5)]
    full = {r.committer_email: r.r for r in committer_rank(fact).collect()}
    assert full == {"a": 1, "b": 2, "c": 2, "d": 4, "e": 5, "f": 5}


def test_rank_desc_with_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 3), ("d", 1)], "k string, v bigint")
    got = {r.k: r.r for r in rank_desc(df, "v", ["k"]).collect()}
    assert got == {"a": 1, "c": 1, "d": 3, "b": 4}


def _streak(fact):
    return sorted((r.committer_email, r.longest_streak) for r in longest_streak(fact).collect())


def test_longest_streak_single_and_ties(spark):
    q2 = _fact(spark, [("a", f"2024-01-0{d}", 1, 1) for d in (1, 2, 3, 5)] +
               [("b", f"2024-01-0{d}", 1, 1) for d in (1, 2)])
    assert _streak(q2) == [("a", 3)]
    q3 = _fact(spark, [("a", f"2024-01-0{d}", 1, 1) for d in (1, 2, 3)] +
               [("b", f"2024-01-0{d}", 2, 1) for d in (7, 8, 9)])
    assert _streak(q3) == [("a", 3), ("b", 3)]
    assert sorted(map(tuple, _by_stages(q3).collect())) == [("a", 3), ("b", 3)]


def test_streak_across_month_and_leap_day(spark):
    """Q4: Dec 31 -> Jan 1 is a run of 2; Feb 28, 29, Mar 1 of 2024 a run of 3."""
    f = _fact(spark, [("a", "2023-12-31", 1, 1), ("a", "2024-01-01", 5, 1),
                      ("b", "2024-02-28", 1, 1), ("b", "2024-02-29", 1, 2), ("b", "2024-03-01", 1, 1),
                      ("b", "2024-03-01", 4, 1)])
    assert _streak(f) == [("b", 3)]
    per = {r.committer_email: r.longest_streak for r in _by_stages(f).collect()}
    assert per == {"b": 3}


def _heat(spark, fact, variant="3h", distinct=False, days=None):
    dd = d_date_rows(days if days is not None else fact.select("dt"))
    return heatmap(fact, dd, d_time(spark, variant), distinct_first=distinct).collect()


def test_heatmap_distinct_collapses_equal_counts(spark):
    """Q5: two facts, same weekday, range and count 2."""
    fact = _fact(spark, [("a", "2024-01-01", 1, 2), ("b", "2024-01-01", 2, 2)])
    assert _heat(spark, fact)[0]["01-03"] == 4
    assert _heat(spark, fact, distinct=True)[0]["01-03"] == 2


def test_heatmap_missing_date_row(spark):
    """Q6: a fact whose date is missing from d_date -> NULL weekday, first."""
    fact = _fact(spark, [("a", "2024-01-01", 1, 2), ("b", "2024-01-02", 1, 3)])
    days = spark.createDataFrame([(D("2024-01-01"),)], "dt date")
    rows = _heat(spark, fact, days=days)
    assert rows[0]["weekday"] is None and rows[0]["01-03"] == 3
    assert rows[1]["weekday"] == "Monday" and rows[1]["01-03"] == 2


def test_heatmap_hour_23(spark):
    """Q7: hour 23 counts in 22-00 with the 3h labels only."""
    fact = _fact(spark, [("a", "2024-01-01", 23, 5)])
    assert _heat(spark, fact)[0]["22-00"] == 5
    lit = _heat(spark, fact, "literal", distinct=True)[0]
    assert all(lit[x] == 0 for x in HOUR_RANGE_LABELS)


def test_heatmap_sorted_by_weekday_number(spark):
    fact = _fact(spark, [("a", f"2024-01-{d:02d}", 5, 1) for d in range(1, 8)])
    assert [r.weekday for r in _heat(spark, fact)] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_local_day_window_boundaries(spark):
    """E1: day D is (D-1) 17:00:00Z .. D 16:59:59Z inclusive at second precision."""
    import datetime as _dt

    from pyspark.sql import functions as F

    from hourglass.functions.clock import api_window_text, local_day_window
    ts = [_dt.datetime(2024, 1, 14, 16, 59, 59), _dt.datetime(2024, 1, 14, 17, 0, 0),
          _dt.datetime(2024, 1, 15, 16, 59, 59, 999999), _dt.datetime(2024, 1, 15, 17, 0, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r.ts for r in df.where(local_day_window(F.col("ts"), D("2024-01-15"), D("2024-01-15"))).collect()]
    assert got == ts[1:3]
    since, until = api_window_text(F.lit(D("2024-01-15")))
    row = spark.range(1).select(since.alias("s"), until.alias("u")).first()
    assert (row.s, row.u) == ("2024-01-14T17:00:00Z", "2024-01-15T16:59:59Z")
