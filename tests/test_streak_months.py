"""Streaks kept by month against the plan over all days."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commit_records import D
from hourglass.operators import streak_months as sm
from hourglass.operators.streaks import longest_streak
from hourglass.sources.daystore import read_days, replace_days
from hourglass.sources.schemas import STREAK_MONTH

DAY = "committer_email string, dt date"
START = dt.date(2023, 11, 20)


def _fact(spark, days):
    return spark.createDataFrame([(e, START + dt.timedelta(days=n)) for e, n in days], DAY)


def _best(days):
    out = {}
    for email in {e for e, _ in days}:
        own = sorted({n for e, n in days if e == email})
        run = best = 0
        for k, n in enumerate(own):
            run = run + 1 if k and own[k - 1] == n - 1 else 1
            best = max(best, run)
        out[email] = best
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 800), st.integers(1, 140)), min_size=1, max_size=8))
def test_any_runs(spark, stretches):
    days = [(e, n + k) for e, n, length in stretches for k in range(length)]
    want = _best(days)
    months = sm.summarise_months(_fact(spark, days))
    assert dict((r.committer_email, r.best) for r in sm.streak_summaries(months).collect()) == want
    # a NULL committer has no best streak of their own in either plan: the comparison is an equality on the length only
    assert sorted(map(str, sm.longest_streak_of_months(months).collect())) == sorted(map(str, longest_streak(_fact(spark, days)).collect()))


def test_combining_is_associative(spark):
    rng = random.Random(2)
    days = sorted({("a", n) for s in range(0, 700, 30) for n in range(s, s + rng.choice([5, 31, 31, 31]))})
    rows = [r.asDict() for r in sm.summarise_months(_fact(spark, days)).drop("committer_email", "dt").orderBy("first_month").collect()]
    item = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in STREAK_MONTH.fields if f.name in sm._FIELDS)
    held = spark.createDataFrame([([tuple(r[c] for c in sm._FIELDS) for r in rows],)], f"s array<struct<{item}>>")
    get = lambda k: F.get("s", F.lit(k))
    for k in range(len(rows) - 2):
        a, b, c = get(k), get(k + 1), get(k + 2)
        one = held.select(sm.combined(sm.combined(a, b), c).alias("x"), sm.combined(a, sm.combined(b, c)).alias("y")).first()
        assert one.x == one.y


def test_only_the_changed_month_is_read(spark, tmp_path):
    root, seen = str(tmp_path / "fact"), []
    days = [("a", n) for n in range(0, 200)] + [("b", n) for n in range(0, 90)] + [("b", n) for n in range(91, 230)]
    fact = _fact(spark, days).withColumn("commit_count", F.lit(1))
    first, last = START, START + dt.timedelta(days=300)
    replace_days(fact.where("NOT (committer_email = 'a' AND dt = DATE'2024-02-10')"), root, "parquet", first, last)

    def read(a, b):
        rows = read_days(spark.read, spark, root, "parquet", fact.schema, a, b)
        seen.append((a, b, rows))
        return rows

    kept = sm.StreakMonths(spark, str(tmp_path / "months"), read)
    kept.update(first, last)
    assert [tuple(r) for r in kept.longest_streak().collect()] == [("b", 139)]
    replace_days(fact.where("dt = DATE'2024-02-10'"), root, "parquet", D("2024-02-10"), D("2024-02-10"))
    done = kept.update(D("2024-02-10"), D("2024-02-10"))
    assert seen[-1][:2] == (D("2024-02-01"), D("2024-02-29")) and done.days == [D("2024-02-01")]
    assert {f.split("dt=")[1][:7] for f in seen[-1][2].inputFiles()} == {"2024-02"}
    assert [tuple(r) for r in kept.longest_streak().collect()] == [("a", 200)] == [tuple(r) for r in longest_streak(fact).collect()]
    # a month that is emptied leaves the summaries
    replace_days(fact.limit(0), root, "parquet", D("2024-02-01"), D("2024-02-29"))
    kept.update(D("2024-02-03"), D("2024-02-04"))
    assert D("2024-02-01") not in kept.months() and D("2024-03-01") in kept.months()
    assert [tuple(r) for r in kept.longest_streak().collect()] == [("b", 128)]


def test_no_months(spark, tmp_path):
    kept = sm.StreakMonths(spark, str(tmp_path / "m"), lambda a, b: spark.createDataFrame([], DAY))
    assert kept.longest_streak().collect() == [] and kept.update(START, START).days == []
    assert kept.longest_streak().collect() == []
