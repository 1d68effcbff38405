"""WARC archives: written with identical payloads stored once, and read back
by verified boundary chains.

Writing.  Of records with equal payloads (SHA-1 and length) of at least
``min_bytes`` bytes, the one with the largest id is a ``response``, the others
are ``revisit`` records that name it and carry digest and length only.  Pages
are not shuffled: the digests that occur more than once are counted first,
and where they are few enough (``BROADCAST_ROWS``, checked) they travel to the
pages; otherwise the two are joined by a shuffle.  Spark's text writer puts
the records down, in files of about ``file_bytes`` each, so a lost task leaves
no half file behind.

Reading.  Files of any size are scanned in byte ranges, cut by Spark's text
reader at line ends; running sums of the ranges' sizes give offsets in the file.
Every line where a record could begin is a candidate, magic inside payloads
included.  Its header gives the offset of its successor, also where header or
payload go on in later ranges; a candidate without a whole header, or whose
payload does not end in the record's end mark, has none.  Pointer jumping,
inside a range first and then between ranges by joins, keeps the candidates that
are reachable from the file's start, which are the records.  A second scan
takes each range from the record that the chain enters it with; of a record that
crosses a border the pieces alone are shuffled.  A task holds a range, or a
record.  A chain that does not end with the file is an error (``strict=False``:
what was reached is returned).  ``read`` runs both scans when it is called and
returns what they wrote.

Edge cases: a null payload is an empty one; ids may be null (a group of null
ids only has responses only); rows with one id and payload that is the
largest are all responses; line breaks in a URL are escaped; an empty table
gives an empty archive, from which nothing is read.  Only the id, url and
payload columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hourglass.llm.common import saved, struct, table
from hourglass.session import scratch_path

FILE_BYTES = 8 << 20
MIN_BYTES = 0
BROADCAST_ROWS = 100_000
RANGE_BYTES = 32 << 20
RANGES_SENT = 200_000  # rows of about 150 bytes
MAGIC = re.compile(rb"^WARC/1\.[01]\r$", re.M)
LENGTH = re.compile(rb"^Content-Length: *(\d{1,18})\r$", re.I | re.M)
BLANK = re.compile(rb"^\r$", re.M)
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
READ = "path string, offset bigint, record_type string, record_id string, refers_to string, target_uri string, " \
       "payload_bytes bigint, payload_digest string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record(page_id, url, payload: str, sha1: str, size: int, response_id, revisit: bool) -> str:
    body = "" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(sha1))}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{response_id}>", f"X-Payload-Length: {size}"]
    lines.append(f"Content-Length: {0 if revisit else size}")
    return "\r\n".join(lines) + "\r\n\r\n" + body + "\r\n\r"  # the writer ends the line with \n


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES) -> None:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload")})
    same = saved(rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size")
                 .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "same-payloads")
    small = same.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(same) if small else same, ["sha1", "size"], "left")
    # A null id equals only a null response id, so in a mixed group it revisits.
    revisit = F.col("size").isNotNull() & F.col("response_id").isNotNull() & ~F.col("response_id").eqNullSafe(F.col("page_id"))
    rows = rows.select("page_id", "url", "payload", "sha1", "size", "response_id", revisit.alias("revisit"))
    schema = struct("value string, file bigint")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                values, files = [], []
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    files.append(written // file_bytes)
                    values.append(_record(*row))
                    written += len(values[-1].encode())
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(files, pa.int64())], schema=to_arrow_schema(schema))

    rows.mapInArrow(records, schema).write.partitionBy("file").option("lineSep", "\n").text(path)


def shown(data: bytes) -> list[tuple]:
    """What one byte range (whole lines) shows, as (kind, place, length, blank),
    places counted from its beginning: a ``start`` for each line where a record
    could begin, with the length its header states and the blank line after
    it, each null if not in this range; an ``end`` behind each end mark; and the
    ``range`` itself: its size, the first length before its first blank line, that line."""
    blanks = np.array([m.start() for m in BLANK.finditer(data)], np.int64)
    found = [(m.start(), int(m[1])) for m in LENGTH.finditer(data)]
    places, starts = [f[0] for f in found], [m.start() for m in MAGIC.finditer(data)]
    out = []
    for at, b, k in zip(starts, np.searchsorted(blanks, starts).tolist(), np.searchsorted(places, starts).tolist()):
        blank = int(blanks[b]) if b < len(blanks) else None
        length = found[k][1] if k < len(found) and (blank is None or places[k] < blank) else None
        out.append(("start", at, length, blank))
    out += [("end", int(b) + 2, None, None) for b in blanks if data[max(b - 2, 0):b] == b"\r\n"]
    first = int(blanks[0]) if len(blanks) else None
    length = found[0][1] if found and (first is None or places[0] < first) else None
    return [*out, ("range", len(data), length, first)]


def leave(starts: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each candidate of a range: the last candidate of its chain inside
    the range, and where the chain goes from there (-1: it breaks off), by
    pointer jumping.  ``starts`` is sorted, ``after`` -1 for what is no record."""
    n = len(starts)
    place = np.searchsorted(starts, after)
    hit = (place < n) & (starts[np.minimum(place, n - 1)] == after)
    jump = np.where(hit, place, np.arange(n))       # the last one points to itself
    hops = 1
    while hops < n:
        jump = jump[jump]
        hops *= 2
    return jump, after[jump]


def _fields(header: bytes) -> dict[str, str]:
    pairs = (line.split(b":", 1) for line in header.split(b"\r\n")[1:] if b":" in line)
    return {k.strip().lower().decode(): v.strip().decode() for k, v in pairs}


def record_at(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(payload's start, its end, the next record's start) of the record at ``at``, if all of it is here."""
    if not MAGIC.match(data, at):
        return None
    blank = BLANK.search(data, at)
    stated = LENGTH.search(data, at, blank.start()) if blank else None
    if stated is None:
        return None
    body = blank.start() + 2
    stop = body + int(stated[1])
    return (body, stop, stop + len(END)) if data[stop:stop + len(END)] == END else None


def row_of(path: str, offset: int, record: bytes, parts: tuple[int, int, int]) -> tuple:
    body, stop, _ = parts
    own = _fields(record[:body - 2])
    kind, payload = own.get("warc-type"), record[body:stop]
    size, digest = len(payload), base32(hashlib.sha1(payload).digest())
    if kind == "revisit":
        size, digest = int(own["x-payload-length"]), own["warc-payload-digest"].partition(":")[2]
    return (path, offset, kind, own.get("warc-record-id"), own.get("warc-refers-to"), own.get("warc-target-uri"), size, digest, payload)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """The lines of one range after the other, put together: (its other columns, its bytes)."""
    key, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for own, lines in groupby(zip(*columns), key=lambda row: row[:-1]):
            if own != key and held:
                yield key, b"\n".join(held) + b"\n"
                held = []
            key = own
            held += [row[-1] for row in lines]
    if held:
        yield key, b"\n".join(held) + b"\n"


def _batches(rows: Iterator[tuple], schema) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    while part := list(islice(rows, 1024)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                       F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


@contextmanager
def _split_at(spark: SparkSession, range_bytes: int):
    """Both scans must see the same ranges, so their sizes hang on nothing but the files."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.openCostInBytes": str(min(range_bytes, 1 << 20)),
              "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _placed(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges (path, block, size, base, total) and candidates (path, block, start, after; -1: no record), by offsets in the file."""
    ranges = found.where("kind = 'range'")
    by, back = Window.partitionBy("path").orderBy("block"), Window.partitionBy("path").orderBy(F.col("block").desc())
    base = F.coalesce(F.sum("place").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("path", "block", "size", base.alias("base"), F.col("place").alias("total"), "length", "blank",
                           F.lag("cr").over(by).alias("cr_before"))
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    known = lambda c, at: F.last(F.when(F.col(c).isNotNull(), F.struct(F.col("block").alias("block"), at.alias("at"))), True).over(later)
    ranges = ranges.withColumns({"next_length": known("length", F.col("length")), "next_blank": known("blank", F.col("base") + F.col("blank"))})
    ranges = saved(ranges, "warc-ranges")
    ends = found.where("kind = 'end'").join(ranges.select("path", "block", "base"), ["path", "block"]).select("path", (F.col("base") + F.col("place")).alias("after"))
    ends = ends.union(ranges.where("blank = 0 AND cr_before").select("path", F.col("base") + 2))
    starts = found.where("kind = 'start'").select("path", "block", "place", F.col("length").alias("own_length"), F.col("blank").alias("own_blank"))
    starts = starts.join(ranges, ["path", "block"])
    blank = F.coalesce(F.col("base") + F.col("own_blank"), F.col("next_blank.at"))
    # A length from a later range counts if the header is open here and does not end before it.
    further = F.when(F.col("own_blank").isNull() & (F.col("next_length.block") <= F.col("next_blank.block")), F.col("next_length.at"))
    after = blank + 2 + F.coalesce("own_length", further) + len(END)
    starts = starts.select("path", "block", (F.col("base") + F.col("place")).alias("start"), after.alias("after"), "size")
    good = ends.distinct().withColumn("good", F.lit(True))
    starts = starts.join(good, ["path", "after"], "left")
    after = F.when(F.col("good") & (F.col("after") <= F.col("size")), F.col("after")).otherwise(-1)
    return ranges, starts.select("path", "block", "start", after.alias("after"))


def _chains(starts: DataFrame) -> DataFrame:
    """(path, block, start, last, leaves): for each candidate, how its chain leaves its range."""
    schema = struct("path string, block bigint, start bigint, last bigint, leaves bigint")

    def run(part):
        part = part.sort_values("start")
        at = part["start"].to_numpy()
        last, leaves = leave(at, part["after"].to_numpy())
        return part[["path", "block", "start"]].assign(last=at[last], leaves=leaves)

    return starts.groupBy("path", "block").applyInPandas(run, schema)


def _reached(chains: DataFrame, ranges: DataFrame) -> DataFrame:
    """The candidates at which the chain from offset 0 enters a range: pointer
    jumping over those that some chain leads to, about one a range.  The hops
    double in each round, so rounds grow with the logarithm of a file's ranges."""
    entered = chains.select("path", F.col("leaves").alias("start")).where("start > 0").distinct()
    enters = saved(chains.join(entered, ["path", "start"], "left_semi").unionByName(chains.where("start = 0")), "warc-enters")
    longest = ranges.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    reached = enters.where("start = 0").select("path", "start")
    jump = enters.select("path", "start", F.col("leaves").alias("to"))
    hops = 1
    while hops < longest:
        reached = saved(reached.union(reached.join(jump, ["path", "start"]).select("path", F.col("to"))).distinct(), "warc-reached")
        on = jump.select("path", F.col("start").alias("to"), F.col("to").alias("further"))
        jump = saved(jump.join(on, ["path", "to"]).select("path", "start", F.col("further").alias("to")), "warc-jump")
        hops *= 2
    return enters.join(reached, ["path", "start"], "left_semi")


def read(spark: SparkSession, path: str, *, payload: bool = False, strict: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all files below ``path``; ``payload`` adds the stored bytes."""
    kinds = struct("path string, size bigint, block bigint, kind string, place bigint, length bigint, blank bigint, cr boolean")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((*key, *row, data.endswith(b"\r\n")) for key, data in _ranges(batches) for row in shown(data)), kinds)

    with _split_at(spark, range_bytes):
        found = saved(_lines(spark, path).mapInArrow(scan, kinds), "warc-shown")
    ranges, starts = _placed(found)
    chains = saved(_chains(starts), "warc-chains")
    reached = saved(_reached(chains, ranges), "warc-reached")
    if strict:
        broken = ranges.select("path", "size").distinct().join(reached.select("path", F.col("leaves").alias("size")), ["path", "size"], "left_anti").first()
        if broken:
            raise ValueError(f"{broken['path']}: the chain of records breaks off")
    # Where a range's first own record begins, and the record that reaches into it from before.
    by = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    crossing = F.when(F.col("leaves") > 0, F.struct(F.col("last").alias("start"), F.col("leaves").alias("until")))
    plan = ranges.select("path", "block", "base", "total", "size").join(reached.select("path", "block", F.col("start").alias("entry"), crossing.alias("crossing")), ["path", "block"], "left")
    plan = plan.withColumn("over", F.last("crossing", True).over(by))
    plan = plan.withColumn("cover", F.when(F.col("over.until") > F.col("base"), F.col("over.start")))
    tail = F.when(F.col("crossing.until") > F.col("base") + F.col("total"), F.col("crossing.start"))
    plan = saved(plan.select("path", "block", "size", "base", "entry", "cover", tail.alias("tail")).where("entry IS NOT NULL OR cover IS NOT NULL"), "warc-plan")
    schema = struct(READ + ", payload binary, block bigint")

    def pieces(key, data):
        name, block, size, base, entry, cover, tail = key
        data = data[:size - base]       # a last line without an end was given one
        at = len(data) if entry is None else entry - base
        if cover is not None:
            yield (name, cover, None, None, None, None, None, None, data[:at], block)
        while at < len(data):
            parts = record_at(data, at)
            if parts is None:       # a record that goes on in the next range, or the chain's end
                if tail is not None and base + at == tail:
                    yield (name, tail, None, None, None, None, None, None, data[at:], block)
                return
            row = row_of(name, base + at, data[at:parts[2]], tuple(p - at for p in parts))
            yield (*(row if payload else (*row[:-1], None)), None)
            at = parts[2]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((row for key, data in _ranges(batches) for row in pieces(key, data)), schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = ((name, at, b"".join(p["payload"] for p in parts)) for batch in batches for name, at, parts in zip(*(c.to_pylist() for c in batch.columns)))
        rows = (row_of(name, at, data, record_at(data, 0)) for name, at, data in whole)
        return _batches(((*(row if payload else (*row[:-1], None)), None) for row in rows), schema)

    # The plan has a row for each range (counted); it is sent in parts of about RANGES_SENT, each with files of its own to scan.
    turns = -(-plan.count() // RANGES_SENT)
    turn = F.pmod(F.xxhash64("path"), F.lit(max(turns, 1)))
    out = spark.createDataFrame([], schema)
    with _split_at(spark, range_bytes):
        for k in range(turns):
            mine = _lines(spark, path).drop("size").where(turn == k).join(F.broadcast(plan.where(turn == k)), ["path", "block"])
            out = out.unionByName(saved(mine.select("path", "block", "size", "base", "entry", "cover", "tail", "line").mapInArrow(walk, schema), "warc-records"))
    parts = out.where("block IS NOT NULL").groupBy("path", "offset").agg(F.sort_array(F.collect_list(F.struct("block", "payload"))).alias("parts"))
    out = out.where("block IS NULL").unionByName(parts.mapInArrow(join, schema))
    return out.drop("block") if payload else out.drop("block", "payload")


def op9_warc(spark, sf_dir):
    """Per page, from the archives: payload size and digest, record type, and the record it revisits."""
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return read(spark, path).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                    number("refers_to").alias("refers_to"))


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, html, max(page_id) AS response FROM p GROUP BY h, html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)
         FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN g USING (h, html)
"""
