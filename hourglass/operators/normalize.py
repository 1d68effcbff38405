"""Bronze commit objects -> flat staging rows, with validation.

Rules (per record):
  commit_sha      ``sha``, '' when absent
  committer_id    -1 when ``committer`` is absent, null or an empty object;
                  otherwise ``committer.id`` (NULL when that key is missing)
  name/email/date from ``commit.committer``; the three keys are required
                  (an explicit JSON null is a NULL value, a missing key is an error)
  dt              business day of the commit date (UTC + offset)

``mode="strict"`` fails the job on the first invalid record, as the original
per-file transform does; ``mode="lenient"`` keeps going and routes invalid
records to a reject split with a reason.  Both are projections, no Python.
The commit time is parsed once for each record: the local time is a column of
its own (``LOCAL_TS``), from which the day and, within a run, the fact's hour
are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.clock import LOCAL_OFFSET_HOURS, parse_commit_ts, to_local
from hourglass.sources.schemas import CORRUPT_COLUMN

REQUIRED_KEYS = ("name", "email", "date")
REJECT_REASONS = ("malformed_json", "missing_commit_committer", "missing_field",
                  "bad_date", "bad_committer_id")


def _fields(bronze: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Read every needed field once; ``_ts`` is the parsed time."""
    cc = F.col("commit.committer")
    committer = F.col("committer")
    cols = [
        F.col("sha").alias("_sha"),
        (committer.isNull() | (F.size(committer) == 0)).alias("_unknown"),
        committer.getItem("id").alias("_id_text"),
        cc.isNull().alias("_no_cc"),
        (F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.map_keys(cc)))
         == 0).alias("_has_all"),
        cc.getItem("name").alias("_name"),
        cc.getItem("email").alias("_email"),
        cc.getItem("date").alias("_date"),
    ]
    if CORRUPT_COLUMN in bronze.columns:
        cols.append(F.col(CORRUPT_COLUMN))
    f = bronze.select(*cols, *[F.col(c) for c in keep])
    return f.withColumn("_ts", parse_commit_ts(F.col("_date")))


def _reject_reason(f: DataFrame) -> Column:
    checks = []
    if CORRUPT_COLUMN in f.columns:
        checks.append((F.col(CORRUPT_COLUMN).isNotNull(), "malformed_json"))
    id_text = F.col("_id_text")
    checks += [
        (F.col("_no_cc"), "missing_commit_committer"),
        (~F.col("_has_all"), "missing_field"),
        (F.col("_ts").isNull(), "bad_date"),
        (~F.col("_unknown") & id_text.isNotNull() & id_text.try_cast("bigint").isNull(),
         "bad_committer_id"),
    ]
    reason = None
    for cond, name in checks:
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    return reason


LOCAL_TS = "local_ts"   # business wall clock of a row, carried within a run


def _flatten(local: Column) -> list[Column]:
    return [
        F.coalesce(F.col("_sha"), F.lit("")).alias("commit_sha"),
        F.when(F.col("_unknown"), F.lit(-1).cast("bigint"))
         .otherwise(F.col("_id_text").try_cast("bigint")).alias("committer_id"),
        F.col("_name").alias("committer_name"),
        F.col("_email").alias("committer_email"),
        F.col("_date").alias("committer_date"),
        local.alias(LOCAL_TS),
    ]


def _with_day(rows: DataFrame, carry_time: bool) -> DataFrame:
    """The staging columns: ``dt`` from the parsed time, which is then dropped unless carried on."""
    out = rows.withColumn("dt", F.col(LOCAL_TS).cast("date"))
    order = ["commit_sha", "committer_id", "committer_name", "committer_email", "committer_date", "dt"]
    rest = [c for c in out.columns if c not in order and (carry_time or c != LOCAL_TS)]
    return out.select(*order, *rest)


def normalize_commits(bronze: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS,
                      mode: str = "strict", keep: tuple[str, ...] = (), carry_time: bool = False) -> DataFrame:
    """Flatten bronze records to the staging schema.

    strict: an invalid record raises when its time (or day) is read, which
    every layer write and every fact does; the check is part of that value, so
    it costs no second parse.  lenient: invalid records are dropped here; get
    them with :func:`split_rejects`.  ``keep`` names extra input columns to
    carry through (e.g. the landed day); ``carry_time`` keeps ``LOCAL_TS``.
    """
    f = _fields(bronze, keep)
    reason = _reject_reason(f)
    local = to_local(F.col("_ts"), offset_hours)
    if mode == "strict":
        local = F.when(reason.isNull(), local).otherwise(F.raise_error(F.concat(
            F.lit("invalid commit record ("), reason, F.lit("), sha="),
            F.coalesce(F.col("_sha"), F.lit("<none>")))).cast("timestamp_ntz"))
    elif mode == "lenient":
        f = f.where(reason.isNull())
    else:
        raise ValueError("mode must be 'strict' or 'lenient'")
    return _with_day(f.select(*_flatten(local), *[F.col(c) for c in keep]), carry_time)


def tag_rejects(bronze: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record, flattened, with ``reject_reason`` (NULL: valid) and the
    corrupt text when the input had a corrupt-record column."""
    f = _fields(bronze, keep)
    extra = [F.col(CORRUPT_COLUMN)] if CORRUPT_COLUMN in f.columns else []
    tagged = f.select(*_flatten(to_local(F.col("_ts"), offset_hours)), _reject_reason(f).alias("reject_reason"),
                      *extra, *[F.col(c) for c in keep])
    return _with_day(tagged, carry_time=True)


def split_tagged(tagged: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid staging rows, rejects) of :func:`tag_rejects`.

    Rejects keep the raw fields that could be read plus the corrupt text;
    never a row with id -1 invented from a broken file.
    """
    good = tagged.where(F.col("reject_reason").isNull()).select(
        "commit_sha", "committer_id", "committer_name", "committer_email", "committer_date", "dt", *keep)
    extra = [CORRUPT_COLUMN] if CORRUPT_COLUMN in tagged.columns else []
    bad = tagged.where(F.col("reject_reason").isNotNull()).select(
        "commit_sha", "committer_date", *extra, "reject_reason", *keep)
    return good, bad


def split_rejects(bronze: DataFrame, offset_hours: int = LOCAL_OFFSET_HOURS,
                  keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Lenient split: (valid staging rows, rejects with ``reject_reason``)."""
    return split_tagged(tag_rejects(bronze, offset_hours, keep), keep)
