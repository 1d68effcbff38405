"""A day's pages end at its first empty one."""

import json
import os

import pytest
from pyspark.sql import functions as F

from commit_records import D, commit, write_json
from hourglass.sources.landed import land_pages, read_bronze

PAGE = r"/page-(\d+)\.json$"


def _read(spark, root, **how):
    rows = read_bronze(spark, root, page_pattern=PAGE, **how)
    assert rows.columns == ["sha", "committer", "commit", "landed_dt"]
    return sorted((str(r.landed_dt), r.sha) for r in rows.collect())


@pytest.mark.parametrize("empty", ["", "[]", " [ \n ]\n"])
def test_pages_behind_an_empty_one_are_left_out(spark, tmp_path, empty):
    root = str(tmp_path / "b")
    for day, pages in {"2024-01-01": "ab_cd", "2024-01-02": "abcde", "2024-01-03": "_ab", "2024-01-04": "ab__c_"}.items():
        for k, sha in enumerate(pages):  # page 10 comes behind page 9
            path = f"{root}/dt={day}/page-{k + 8}.json"
            write_json(path, empty, raw=True) if sha == "_" else write_json(path, [commit(sha=sha), commit(sha=sha + "}")])
    first, second, fourth = [("2024-01-01", x) for x in "ab"], [("2024-01-02", x) for x in "abcde"], [("2024-01-04", x) for x in "ab"]
    want = sorted((d, s) for d, x in first + second + fourth for s in (x, x + "}"))
    assert _read(spark, root) == want
    assert _read(spark, root, first=D("2024-01-02"), last=D("2024-01-03")) == [r for r in want if r[0] == "2024-01-02"]
    assert _read(spark, root, first=D("2030-01-01"), last=D("2030-01-03")) == []
    assert len(read_bronze(spark, root, D("2024-01-01"), D("2024-01-01")).collect()) == 8


def test_pages_need_a_number_and_whole_files(spark, tmp_path):
    write_json(str(tmp_path / "b" / "dt=2024-01-01" / "commits.json"), [commit()])
    with pytest.raises(Exception, match="no page number"):
        _read(spark, str(tmp_path / "b"))
    with pytest.raises(ValueError):
        _read(spark, str(tmp_path / "b"), layout="array_ranges")


def test_folders_are_listed_by_few_tasks_and_pages_behind_the_end_are_not_parsed(spark, tmp_path):
    """A folder for each page, many more than cores; names that are URI-encoded or look like patterns."""
    root, pages = str(tmp_path / "b c"), 150
    for k in range(pages):
        write_json(f"{root}/dt=2024-01-01/page={k}/a {{b}} [1]%20.json", {2: "[]", 9: "[{no json"}.get(k, [commit(sha=f"s{k}")]), raw=k in (2, 9))
        write_json(f"{root}/dt=2024-01-02/page={k}/a.json", [commit(sha=f"t{k:03}")])
    sc = spark.sparkContext
    sc.setJobGroup("pages", "pages")
    try:
        got = sorted(r.sha for r in read_bronze(spark, root, page_pattern=r"/page=(\d+)/").collect())
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == ["s0", "s1"] + [f"t{k:03}" for k in range(pages)]
    told = sc.statusTracker()
    stages = [told.getStageInfo(s) for job in told.getJobIdsForGroup("pages") for s in told.getJobInfo(job).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 4 * sc.defaultParallelism


def test_landed_pages_are_full_but_for_one_of_each_group(spark, tmp_path):
    """At most ``page_size`` commits each, and hardly more pages than that needs; null and repeated shas are rows too."""
    root = str(tmp_path / "b")
    sha = F.when(F.col("id") % 50 != 0, (F.col("id") % 900).cast("string"))
    person = F.create_map(F.lit("name"), F.lit("n"), F.lit("email"), F.lit("e"), F.lit("date"), F.lit("2024-01-01T18:00:00Z"))
    rows = spark.range(1003).select(sha.alias("sha"), F.create_map(F.lit("id"), F.lit("1")).alias("committer"), F.struct(person.alias("committer")).alias("commit"),
                                    F.when(F.col("id") < 1000, D("2024-01-01")).otherwise(D("2024-01-02")).alias("dt"))
    land_pages(rows, root, page_size=10)
    sizes = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".txt"):
                with open(f"{folder}/{name}") as page:
                    sizes.setdefault(os.path.basename(folder), []).append(len(json.load(page)))
    assert set(sizes) == {"dt=2024-01-01", "dt=2024-01-02"} and sizes["dt=2024-01-02"] == [3]
    first = sizes["dt=2024-01-01"]
    assert sum(first) == 1000 and max(first) == 10 and len(first) <= 102 and sum(n < 10 for n in first) <= 2
    got = sorted((str(r.landed_dt), str(r.sha)) for r in read_bronze(spark, root, file_glob="*.txt").collect())
    assert got == sorted((str(r.dt), str(r.sha)) for r in rows.collect())
