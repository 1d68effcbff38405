"""Adapter from the driver's ``events`` table to commit records.

``events`` (event_id, ts, user_id, event_type, ...) is the only test table with
a time of day, so it stands in for commits.  The mapping is deterministic and
is mirrored by the DuckDB oracle (``plans.oracle``):

  sha             event_id as text
  committer       {} when event_id % 11 = 0 (unknown user -> id -1),
                  else {"id": user_id % 7}
  commit.committer.name   'user' || user_id
  commit.committer.email  fine:   'u' || user_id || '@example.com'
                          coarse: event_type || '@example.com'
                          dirty:  NULL when event_id % 97 = 0,
                                  else event_type || user_id % 7 || '@example.com'
  commit.committer.date   ts as UTC text YYYY-MM-DDTHH:MM:SSZ

Every event becomes one commit: no rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions.clock import format_commit_ts

EMAIL_MODES = ("fine", "coarse", "dirty")


def email_expr(mode: str) -> Column:
    uid, etype, eid = F.col("user_id"), F.col("event_type"), F.col("event_id")
    if mode == "fine":
        return F.concat(F.lit("u"), uid.cast("string"), F.lit("@example.com"))
    if mode == "coarse":
        return F.concat(etype, F.lit("@example.com"))
    if mode == "dirty":
        return F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(etype, (uid % 7).cast("string"), F.lit("@example.com")))
    raise ValueError(f"email mode must be one of {EMAIL_MODES}, got {mode!r}")


def _bronze(events: DataFrame, committer: Column, person: Column) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("sha"),
        committer.alias("committer"),
        F.struct(person.alias("committer")).alias("commit"),
        F.col("ts"),
    )


def _known_user() -> Column:
    return F.create_map(F.lit("id"), (F.col("user_id") % 7).cast("string"))


def _unknown_user() -> Column:
    return F.create_map().cast("map<string,string>")


def _name() -> Column:
    return F.concat(F.lit("user"), F.col("user_id").cast("string"))


def events_as_bronze(events: DataFrame, email: str = "fine") -> DataFrame:
    """Shape events like API commit objects (``sources.schemas.BRONZE_COMMIT``).

    ``ts`` is kept alongside so callers can land files by day or apply the
    extraction window.
    """
    committer = F.when(F.col("event_id") % 11 == 0, _unknown_user()).otherwise(_known_user())
    person = F.create_map(F.lit("name"), _name(), F.lit("email"), email_expr(email),
                          F.lit("date"), format_commit_ts(F.col("ts")))
    return _bronze(events, committer, person)


def events_as_faulty_bronze(events: DataFrame) -> DataFrame:
    """The ``fine`` mapping with three deterministic faults injected, for the
    validation path (every event is still one record):

      event_id % 83 = 0   commit.committer has no ``email`` key
      event_id % 89 = 0   date text ``YYYY-MM-DD HH:MM:SS`` (wrong format)
      event_id % 79 = 0   committer {"id": "n/a"} (unless it is the empty object)
    """
    eid = F.col("event_id")
    date_text = F.when(eid % 89 == 0, F.substring(F.col("ts").cast("string"), 1, 19)) \
                 .otherwise(format_commit_ts(F.col("ts")))
    committer = (F.when(eid % 11 == 0, _unknown_user())
                 .when(eid % 79 == 0, F.create_map(F.lit("id"), F.lit("n/a")))
                 .otherwise(_known_user()))
    person = F.when(eid % 83 == 0, F.create_map(F.lit("name"), _name(), F.lit("date"), date_text)) \
              .otherwise(F.create_map(F.lit("name"), _name(), F.lit("email"), email_expr("fine"),
                                      F.lit("date"), date_text))
    return _bronze(events, committer, person)


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
