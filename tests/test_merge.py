"""Upsert semantics (FIXTURES M1-M11, traps T3-T5)."""

import pytest

from commit_records import D
from hourglass.operators.merge import merge_d_date_table, merge_fact_table, upsert_fact
from hourglass.operators.dims import d_date_rows
from hourglass.sources.schemas import D_DATE, F_COMMITS_HOURLY

DAY, PREV = D("2024-01-10"), D("2024-01-09")


def _fact(spark, rows):
    """(email, day, hour, id, count)"""
    return spark.createDataFrame(
        [(int(d.strftime("%Y%m%d")), h, i, e, c, d) for e, d, h, i, c in rows], F_COMMITS_HOURLY)


def _set(df):
    return sorted((r.committer_email or "", r.dt, r.d_time_id, r.committer_id, r.commit_count)
                  for r in df.collect())


def test_fact_arms(spark):
    target = _fact(spark, [("a", DAY, 1, 1, 5),      # M1 matched
                           ("c", DAY, 3, 1, 4),      # M3 target-only in the run -> removed
                           ("c", PREV, 3, 1, 4)])    # M4 outside the run -> kept
    source = _fact(spark, [("a", DAY, 1, 9, 8),      # M1 -> count 8, target id 1 kept
                           ("b", DAY, 2, 2, 3)])     # M2 inserted
    got = _set(merge_fact_table(target, source, DAY, DAY))
    assert got == sorted([("a", DAY, 1, 1, 8), ("b", DAY, 2, 2, 3), ("c", PREV, 3, 1, 4)])
    zeroed = _set(merge_fact_table(target, source, DAY, DAY, delete_zero=False))
    assert ("c", DAY, 3, 1, 0) in zeroed


def test_fact_empty_source_empties_day(spark):
    """M5"""
    target = _fact(spark, [("a", DAY, 1, 1, 5), ("a", PREV, 1, 1, 5)])
    empty = spark.createDataFrame([], F_COMMITS_HOURLY)
    assert _set(merge_fact_table(target, empty, DAY, DAY)) == [("a", PREV, 1, 1, 5)]


def test_fact_null_email(spark):
    """M6 / T4: NULL never matches, the old row goes, the new one comes."""
    target = _fact(spark, [(None, DAY, 4, 1, 2)])
    source = _fact(spark, [(None, DAY, 4, 6, 6)])
    assert _set(merge_fact_table(target, source, DAY, DAY)) == [("", DAY, 4, 6, 6)]


def test_fact_duplicate_keys(spark):
    """M7 / T3"""
    source = _fact(spark, [("a", DAY, 1, -1, 2), ("a", DAY, 1, 7, 3)])
    empty = spark.createDataFrame([], F_COMMITS_HOURLY)
    assert _set(merge_fact_table(empty, source, DAY, DAY, "combine")) == [("a", DAY, 1, 7, 5)]
    # error policy: first load inserts both, a re-run fails
    first = merge_fact_table(empty, source, DAY, DAY, "error")
    assert len(_set(first)) == 2
    with pytest.raises(Exception, match="several source rows"):
        upsert_fact(first, source, DAY, DAY, "error").collect()


def test_fact_idempotent(spark):
    """M8"""
    target = _fact(spark, [("a", DAY, 1, 1, 5), ("c", DAY, 3, 1, 4)])
    source = _fact(spark, [("a", DAY, 1, 9, 8), ("b", DAY, 2, 2, 3), ("b", DAY, 2, 3, 1)])
    once = merge_fact_table(target, source, DAY, DAY)
    once_rows = _set(once)
    twice = merge_fact_table(spark.createDataFrame(once.collect(), F_COMMITS_HOURLY), source, DAY, DAY)
    assert _set(twice) == once_rows


def test_fact_range_equals_days(spark):
    """M9: one range run equals the days one by one."""
    days = [D("2024-01-01"), D("2024-01-02"), D("2024-01-03")]
    source = _fact(spark, [("a", d, h, 1, h + 1) for d in days for h in (1, 5)])
    empty = spark.createDataFrame([], F_COMMITS_HOURLY)
    ranged = _set(merge_fact_table(empty, source, days[0], days[-1]))
    state = empty
    for d in days:
        state = spark.createDataFrame(merge_fact_table(state, source, d, d).collect(), F_COMMITS_HOURLY)
    assert _set(state) == ranged


def _dd(spark, rows):
    return spark.createDataFrame(rows, D_DATE)


def test_d_date_arms(spark):
    wrong = (20240110, "2024-01-10", "Someday", 9, DAY)
    other = (20240109, "2024-01-09", "Tuesday", 2, PREV)
    target = _dd(spark, [wrong, other])
    source = d_date_rows(spark.createDataFrame([(DAY,), (D("2024-01-11"),)], "dt date"))
    got = sorted(tuple(r) for r in merge_d_date_table(target, source, DAY, D("2024-01-11")).collect())
    assert wrong in got and other in got                         # M10 kept as is
    assert (20240111, "2024-01-11", "Thursday", 4, D("2024-01-11")) in got
    gone = merge_d_date_table(target, source.where("dt > DATE'2024-01-10'"), DAY, DAY).collect()
    assert sorted(tuple(r) for r in gone) == [other]             # M11 deleted


def test_fact_by_key_equals_combined_fact(spark):
    from hourglass.operators.facts import hourly_fact, hourly_fact_by_key
    from hourglass.operators.merge import combine_duplicate_keys
    from hourglass.sources.schemas import STAGING
    rows = [("s1", -1, "n", "a", "2024-01-09T18:00:00Z", D("2024-01-10")),
            ("s2", 7, "n", "a", "2024-01-09T18:30:00Z", D("2024-01-10")),
            ("s3", 2, "n", None, "2024-01-09T18:10:00Z", D("2024-01-10")),
            ("s4", 3, "n", None, "2024-01-09T18:20:00Z", D("2024-01-10")),
            ("s5", 1, "n", "b", "2024-01-10T03:00:00Z", D("2024-01-10"))]
    st = spark.createDataFrame(rows, STAGING)
    a = sorted(tuple(r) for r in hourly_fact_by_key(st).collect())
    b = sorted(tuple(r) for r in combine_duplicate_keys(hourly_fact(st)).collect())
    assert a == b and len(a) == 3
