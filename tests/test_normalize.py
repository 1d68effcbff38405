"""Bronze -> staging rules (FIXTURES B1-B14)."""

import datetime as dt

import pytest

from commit_records import D, commit, write_json
from hourglass.operators.normalize import normalize_commits, split_rejects
from hourglass.sources.landed import read_bronze


def _read(spark, tmp_path, records, day="2024-01-02", layout="array", mode="strict", raw=None):
    root = str(tmp_path / "bronze")
    write_json(f"{root}/dt={day}/commits.json", raw if raw is not None else records, raw=raw is not None)
    return read_bronze(spark, root, D(day), D(day), layout=layout, mode=mode)


def _rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["commit_sha"])


def test_ids_days_and_defaults(spark, tmp_path):
    recs = [
        commit("b1", {"id": 7}, date="2024-01-01T18:00:00Z"),            # B1 crosses midnight
        commit("b2", None, date="2024-01-02T16:59:59Z"),                  # B2 last second of day
        commit("b3", {"id": 3}, date="2024-01-02T17:00:00Z"),             # B3 first second of next
        commit("b4", {}, date="2024-01-02T03:00:00Z"),                    # B4 empty object
        commit("b5a", {"login": "y"}, date="2024-01-02T03:00:00Z"),       # B5 no id
        commit("b5b", {"id": None}, date="2024-01-02T03:00:00Z"),         # B5 null id
        commit(None, {"id": 1}, date="2024-01-02T03:00:00Z"),             # B6 no sha
        commit("b11a", {"id": 1}, date="2024-02-28T20:00:00Z"),           # B11 leap day
        commit("b11b", {"id": 1}, date="2023-12-31T20:00:00Z"),           # B11 new year
        commit("b14", {"id": 42, "login": "q", "site_admin": False, "plan": {"x": [1, 2]},
                       "urls": ["a", "b"]}, date="2024-01-02T03:00:00Z"),  # B14 real-size object
    ]
    got = {r["commit_sha"]: r for r in _rows(normalize_commits(_read(spark, tmp_path, recs)))}
    assert got["b1"]["committer_id"] == 7 and got["b1"]["dt"] == D("2024-01-02")
    assert got["b2"]["committer_id"] == -1 and got["b2"]["dt"] == D("2024-01-02")
    assert got["b3"]["dt"] == D("2024-01-03")
    assert got["b4"]["committer_id"] == -1
    assert got["b5a"]["committer_id"] is None and got["b5b"]["committer_id"] is None
    assert got[""]["committer_id"] == 1
    assert got["b11a"]["dt"] == D("2024-02-29") and got["b11b"]["dt"] == D("2024-01-01")
    assert got["b14"]["committer_id"] == 42
    assert got["b1"]["committer_date"] == "2024-01-01T18:00:00Z"


def test_null_email_is_a_value_not_an_error(spark, tmp_path):
    df = normalize_commits(_read(spark, tmp_path, [commit("x", {"id": 1}, email=None)]))
    assert [r.committer_email for r in df.collect()] == [None]


@pytest.mark.parametrize("rec,reason", [
    (commit("b7", {"id": 1}, drop=("email",)), "missing_field"),             # B7
    (commit("b8", {"id": 1}, date="2024-01-02 03:00:00"), "bad_date"),       # B8
    (commit("b8b", {"id": 1}, date="2024-02-30T03:00:00Z"), "bad_date"),
    (commit("bi", {"id": "n/a"}), "bad_committer_id"),
])
def test_invalid_records(spark, tmp_path, rec, reason):
    bronze = _read(spark, tmp_path, [rec, commit("ok", {"id": 2})])
    with pytest.raises(Exception, match="invalid commit record"):
        normalize_commits(bronze).collect()
    good, bad = split_rejects(bronze)
    assert [r.commit_sha for r in good.collect()] == ["ok"]
    assert [(r.commit_sha, r.reject_reason) for r in bad.collect()] == [(rec["sha"], reason)]


def test_strict_check_is_part_of_the_day(spark, tmp_path):
    bronze = _read(spark, tmp_path, [commit("b7", {"id": 1}, drop=("date",))])
    with pytest.raises(Exception, match="invalid commit record"):
        normalize_commits(bronze).select("dt").collect()


def test_empty_files_and_other_suffixes(spark, tmp_path):
    root = tmp_path / "bronze"
    write_json(f"{root}/dt=2024-01-02/commits.json", [])                        # B9 []
    write_json(f"{root}/dt=2024-01-02/more.json", "", raw=True)                 # B9 zero-length
    write_json(f"{root}/dt=2024-01-02/notes.txt", [commit("t", {"id": 1})])     # B10 ignored
    write_json(f"{root}/dt=2024-01-03/commits.json", [commit("k", {"id": 1})])
    assert read_bronze(spark, str(root), D("2024-01-02"), D("2024-01-02")).count() == 0
    assert read_bronze(spark, str(root), D("2024-01-02"), D("2024-01-03")).count() == 1


def test_truncated_file(spark, tmp_path):
    """B12: never a row with id -1 from a broken file."""
    text = '[\n  {"sha": "a", "committer": {"id": 1}, "commit": {"committer": {"name": "n", "em'
    strict = _read(spark, tmp_path / "s", None, raw=text)
    with pytest.raises(Exception):
        normalize_commits(strict).collect()
    lenient = _read(spark, tmp_path / "l", None, raw=text, mode="lenient")
    good, bad = split_rejects(lenient)
    assert good.count() == 0
    assert [r.reject_reason for r in bad.collect()] == ["malformed_json"]


def test_json_lines_layout(spark, tmp_path):
    """B13: JSON Lines are read as lines, not as one multi-line document."""
    import json
    text = "\n".join(json.dumps(commit(s, {"id": 1})) for s in ("l1", "l2"))
    assert _read(spark, tmp_path, None, raw=text, layout="lines").count() == 2


def test_landed_day_is_kept(spark, tmp_path):
    bronze = _read(spark, tmp_path, [commit("a", {"id": 1}, date="2024-01-01T18:00:00Z")])
    row = normalize_commits(bronze, keep=("landed_dt",)).first()
    assert row.landed_dt == dt.date(2024, 1, 2) == row.dt


def test_pages_are_concatenated_without_dedup(spark, tmp_path):
    """E2: two array pages of one day, one commit on both -> both rows kept."""
    root = tmp_path / "bronze"
    write_json(f"{root}/dt=2024-01-02/page1.json", [commit("p1", {"id": 1}), commit("both", {"id": 1})])
    write_json(f"{root}/dt=2024-01-02/page2.json", [commit("both", {"id": 1}), commit("p2", {"id": 2})])
    shas = sorted(r.commit_sha for r in normalize_commits(
        read_bronze(spark, str(root), D("2024-01-02"), D("2024-01-02"))).collect())
    assert shas == ["both", "both", "p1", "p2"]


def test_day_filter_is_exact(spark, tmp_path):
    """S1: a folder whose name only starts like the day is not read as that day."""
    root = tmp_path / "bronze"
    write_json(f"{root}/dt=2024-01-02/commits.json", [commit("a", {"id": 1})])
    write_json(f"{root}/dt=2024-01-02_old/commits.json", [commit("old", {"id": 1})])
    got = [r.commit_sha for r in normalize_commits(
        read_bronze(spark, str(root), D("2024-01-02"), D("2024-01-02"))).collect()]
    assert got == ["a"]
