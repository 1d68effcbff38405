"""Array files in byte ranges: the same records wherever they are cut."""

import json
import os

import pytest
from pyspark.sql import functions as F

from commit_records import D, commit, write_json
from hourglass.sources.landed import land_arrays, read_bronze
from hourglass.sources.events import events_as_bronze, read_events
from hourglass.functions.clock import local_day

ODD = ["plain", "}", "{", "]}", "a\"}{\\", "\\\\", "\\\"}", "é😀}", "\n,\t[", "", "},{", "\"},{\"sha\":\"x\"", "\\u007d\\"]


def _cut(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def cuts(spark):
    yield lambda size: _cut(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _plain(value):
    """Nested values arrive as JSON text, of which only the white space may differ."""
    return json.loads(value) if value and value[0] == "{" else value


def _rows(df):
    return sorted((str(r.landed_dt), r.sha or "", str(sorted((k, _plain(v)) for k, v in (r.committer or {}).items())),
                   str(sorted(((r.commit.committer if r.commit else None) or {}).items()))) for r in df.collect())


def _records():
    return [commit(sha=f"s{k}", committer={"id": k, "x": {"y": [1, {"z": text}]}} if k % 3 else {}, name=text, email=text + "@x")
            for k, text in enumerate(ODD)]


@pytest.mark.parametrize("indent", [None, 2])
def test_cut_at_every_byte(spark, tmp_path, cuts, indent):
    path = str(tmp_path / "b" / "dt=2024-01-02" / "c.json")
    os.makedirs(os.path.dirname(path))
    with open(path, "w", encoding="utf-8") as out:
        json.dump(_records()[4:9], out, indent=indent, ensure_ascii=False)
    size = os.path.getsize(path)
    want = _rows(read_bronze(spark, str(tmp_path / "b"), layout="array"))
    assert len(want) == 5
    for cut in [*range(7, 60, 9), *range(61, size, max(size // 8, 1)), size + 1]:  # ranges begin at all multiples of each
        cuts(cut)
        got = read_bronze(spark, str(tmp_path / "b"), layout="array_ranges")
        assert _rows(got) == want, cut
    cuts(7)
    starts = read_bronze(spark, str(tmp_path / "b"), layout="lines").rdd.getNumPartitions()
    assert starts > 20  # the file was really read in that many ranges


def test_several_files_and_days(spark, tmp_path, cuts):
    root = str(tmp_path / "b")
    records = _records()
    for day, pages in {"2024-01-02": [records, [], records[:1]], "2024-01-03": [records[3:]], "2024-01-04": [[]]}.items():
        for k, page in enumerate(pages):
            write_json(f"{root}/dt={day}/page{k}.json", page)
    write_json(f"{root}/dt=2024-01-05/empty.json", "", raw=True)
    write_json(f"{root}/dt=2024-01-05/blank.json", " \n", raw=True)
    write_json(f"{root}/dt=2024-01-02/readme.md", "not } json", raw=True)
    for cut in (40, 333, 100_000):
        cuts(cut)
        for first, last in ((None, None), (D("2024-01-03"), D("2024-01-04")), (D("2024-01-04"), D("2024-01-09")), (D("2030-01-01"), None)):
            want = _rows(read_bronze(spark, root, first, last, layout="array"))
            assert _rows(read_bronze(spark, root, first, last, layout="array_ranges")) == want


@pytest.mark.parametrize("text", ['[{"sha":"a"}', '[{"sha":"a"}]]', '[{"sha":"a"},{"sha":"b]', '{"sha":"a"}', '[{"sha":"a"} {"sha":"b"}]',
                                  '[{"sha":"a"},,{"sha":"b"}]', '[{"sha":"a"},1,{"sha":"b"}]', '[{"sha":"a"},{"sha" "b"}]', '[1]', '"}"', '[{"sha":"a"}] x'])
def test_other_files_fail_in_strict_mode(spark, tmp_path, cuts, text):
    write_json(str(tmp_path / "b" / "dt=2024-01-02" / "c.json"), text, raw=True)
    for cut in (9, 1000):
        cuts(cut)
        with pytest.raises(Exception):
            read_bronze(spark, str(tmp_path / "b"), layout="array_ranges").collect()


def test_lenient_mode_keeps_what_parses(spark, tmp_path, cuts):
    root = str(tmp_path / "b" / "dt=2024-01-02")
    write_json(f"{root}/good.json", [commit(sha="a")])
    write_json(f"{root}/part.json", '[{"sha":"b"},{"sha" "c"}, 1, {"sha":"d"},{"sha":"e"}]', raw=True)
    write_json(f"{root}/open.json", '[{"sha":"f"},{"sha":"g]', raw=True)
    for cut in (11, 1000):
        cuts(cut)
        rows = read_bronze(spark, str(tmp_path / "b"), layout="array_ranges", mode="lenient").collect()
        assert sorted(r.sha for r in rows if r._corrupt_record is None) == ["a", "b", "e"]
        corrupt = sorted(r._corrupt_record for r in rows if r._corrupt_record is not None)
        assert len(corrupt) == 3 and corrupt[0].startswith(', 1, {"sha":"d"') and corrupt[1].endswith("open.json") and corrupt[2] == '{"sha" "c"}'


def test_landed_arrays_of_events(spark, tmp_path, cuts):
    """A whole table as one array a day, in ranges of 8 KB."""
    landed = events_as_bronze(read_events(spark, "/root/testdata/sf0.001"), "dirty").withColumn("dt", local_day(F.col("ts")))
    land_arrays(landed, str(tmp_path / "b"))
    files = [f for _, _, names in os.walk(tmp_path / "b") for f in names if f.endswith(".txt")]
    assert len(files) == landed.select("dt").distinct().count()
    cuts(8192)
    got = read_bronze(spark, str(tmp_path / "b"), layout="array_ranges", file_glob="*.txt")
    assert _rows(got) == _rows(landed.withColumnRenamed("dt", "landed_dt"))
