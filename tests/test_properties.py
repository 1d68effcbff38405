"""Property tests: Spark operators against brute-force Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourglass.functions.clock import local_day, local_hour, parse_commit_ts
from hourglass.operators.merge import merge_fact_table
from hourglass.operators.ranking import rank_desc
from hourglass.operators.streaks import (daily_activity, longest_streak, longest_streak_from_lengths,
                                         streak_boundaries, streak_groups, streak_lengths)
from hourglass.sources.schemas import F_COMMITS_HOURLY

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
PATTERN = "%Y-%m-%dT%H:%M:%SZ"


def _py_parse(s):
    try:
        return dt.datetime.strptime(s, PATTERN)
    except (ValueError, TypeError):
        return None


def _render(d: dt.datetime, style: int) -> str:
    if style == 0:
        return d.strftime(PATTERN)
    if style == 1:   # unpadded fields
        return f"{d.year:04d}-{d.month}-{d.day}T{d.hour}:{d.minute}:{d.second}Z"
    if style == 2:   # lower-case letters
        return d.strftime(PATTERN).lower()
    return f"{d.year:04d}-{d.month:02d}-{d.day:2d}T{d.hour:02d}:{d.minute:02d}:{d.second:02d}Z"


_valid = st.builds(_render, st.datetimes(min_value=dt.datetime(1, 1, 1), max_value=dt.datetime(9999, 12, 30)),
                   st.integers(0, 3))
_noise = st.text(alphabet="0123456789-:TZtz .x", min_size=0, max_size=24)
_near = st.builds(lambda y, mo, d, h, mi, s: f"{y:04d}-{mo:02d}-{d:02d}T{h:02d}:{mi:02d}:{s:02d}Z",
                  st.integers(0, 9999), st.integers(0, 13), st.integers(0, 32),
                  st.integers(0, 25), st.integers(0, 61), st.integers(0, 62))


@SETTINGS
@given(st.lists(st.one_of(_valid, _noise, _near), min_size=1, max_size=60))
def test_parse_matches_strptime(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.ts for r in df.select(parse_commit_ts(F.col("s")).alias("ts")).collect()]
    assert got == [_py_parse(t) for t in texts]


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2099, 12, 31)),
                min_size=1, max_size=40))
def test_local_day_and_hour(spark, stamps):
    df = spark.createDataFrame([(d.strftime(PATTERN),) for d in stamps], "s string")
    ts = parse_commit_ts(F.col("s"))
    got = [(r.d, r.h) for r in df.select(local_day(ts).alias("d"), local_hour(ts).alias("h")).collect()]
    want = []
    for d in stamps:
        loc = d.replace(microsecond=0) + dt.timedelta(hours=7)
        want.append((loc.date(), loc.hour))
    assert got == want


def _fact(spark, rows):
    return spark.createDataFrame(
        [(int(d.strftime("%Y%m%d")), h, i, e, c, d) for e, d, h, i, c in rows], F_COMMITS_HOURLY)


def _py_streak(days_by_email):
    best = {}
    for e, days in days_by_email.items():
        run, top, prev = 0, 0, None
        for d in sorted(set(days)):
            run = run + 1 if prev is not None and (d - prev).days == 1 else 1
            top, prev = max(top, run), d
        best[e] = top
    m = max(best.values())
    return sorted((e, v) for e, v in best.items() if v == m)


BASE = dt.date(2024, 2, 20)
_days = st.lists(st.integers(0, 20).map(lambda k: BASE + dt.timedelta(days=k)), min_size=1, max_size=12)


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), _days, min_size=1))
def test_longest_streak_brute_force(spark, days_by_email):
    rows = [(e, d, 3, 1, 1) for e, ds in days_by_email.items() for d in ds]
    fact = _fact(spark, rows)
    want = _py_streak(days_by_email)
    assert sorted(map(tuple, longest_streak(fact).collect())) == want
    assert sorted(map(tuple, longest_streak_from_lengths(
        streak_lengths(streak_groups(streak_boundaries(daily_activity(fact))))).collect())) == want


D1, D2, D3 = dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 11)
_key = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([D1, D2, D3]), st.integers(0, 2))
_row = st.tuples(_key, st.integers(-1, 3), st.integers(1, 5))


def _model(target, source, first, last):
    """MERGE (update / insert / zero) then DELETE zeros, row by row."""
    def key(r):
        return (r[0], r[1], r[2])
    src = {}
    for e, d, h, i, c in source:
        if first <= d <= last:
            k = (e, d, h)
            pi, pc = src.get(k, (None, 0))
            src[k] = (i if pi is None else max(pi, i), pc + c)
    out, matched = [], set()
    for r in target:
        e, d, h, i, c = r
        if not (first <= d <= last):
            out.append(r)
            continue
        k = key(r)
        if e is not None and k in src:
            matched.add(k)
            out.append((e, d, h, i, src[k][1]))
        # target-only (or NULL email) rows of the run: zeroed, then deleted
    for k, (i, c) in src.items():
        if k not in matched:
            out.append((k[0], k[1], k[2], i, c))
    return sorted((e or "", d, h, i, c) for e, d, h, i, c in out if c != 0)


@SETTINGS
@given(st.lists(_row, max_size=12, unique_by=lambda r: r[0]), st.lists(_row, max_size=12),
       st.sampled_from([(D2, D2), (D1, D2), (D1, D3)]))
def test_merge_fact_model(spark, target_rows, source_rows, run):
    target = [(k[0], k[1], k[2], i, c) for k, i, c in target_rows]
    source = [(k[0], k[1], k[2], i, c) for k, i, c in source_rows]
    got = merge_fact_table(_fact(spark, target), _fact(spark, source), run[0], run[1]).collect()
    got = sorted((r.committer_email or "", r.dt, r.d_time_id, r.committer_id, r.commit_count) for r in got)
    assert got == _model(target, source, run[0], run[1])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=30))
def test_rank_desc_brute_force(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v bigint")
    got = {r.k: r.r for r in rank_desc(df, "v", ["k"]).collect()}
    nonnull = [v for v in values if v is not None]
    want = {}
    for k, v in enumerate(values):
        want[k] = (1 + sum(1 for w in nonnull if w > v)) if v is not None else len(nonnull) + 1
    assert got == want


_fact_row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9),
                      st.integers(0, 23), st.integers(1, 4))


@SETTINGS
@given(st.lists(_fact_row, min_size=1, max_size=25), st.sets(st.integers(0, 9), max_size=10),
       st.booleans(), st.sampled_from(["3h", "literal"]))
def test_heatmap_brute_force(spark, rows, known_days, distinct, variant):
    from hourglass.functions.clock import HOUR_RANGE_LABELS
    from hourglass.operators.dims import d_date_rows, d_time
    from hourglass.operators.heatmap import heatmap
    base = dt.date(2024, 3, 4)                       # a Monday
    fact = _fact(spark, [(e, base + dt.timedelta(days=k), h, 1, c) for e, k, h, c in rows])
    days = spark.createDataFrame([(base + dt.timedelta(days=k),) for k in known_days] or [(None,)],
                                 "dt date").where("dt IS NOT NULL")
    got = {r.weekday: tuple(r[x] for x in HOUR_RANGE_LABELS)
           for r in heatmap(fact, d_date_rows(days), d_time(spark, variant), distinct).collect()}

    def label(h):
        if variant == "3h":
            if h == 0 or h >= 22:
                return "22-00"
            lo = (h - 1) // 3 * 3 + 1
            return f"{lo:02d}-{lo + 2:02d}"
        return "22-00" if h == 0 else f"{h:02d}-{h + 2:02d}"
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    cells = []
    for e, k, h, c in rows:
        wd = names[(base + dt.timedelta(days=k)).weekday()] if k in known_days else None
        wn = (base + dt.timedelta(days=k)).isoweekday() if k in known_days else None
        cells.append((wd, wn, label(h), c))
    if distinct:
        cells = list(set(cells))
    want = {}
    for wd, wn, lab, c in cells:
        acc = want.setdefault(wd, dict.fromkeys(HOUR_RANGE_LABELS, 0))
        if lab in acc:
            acc[lab] += c
    assert got == {wd: tuple(acc[x] for x in HOUR_RANGE_LABELS) for wd, acc in want.items()}
