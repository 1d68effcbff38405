"""The analyst questions as SQL views over a warehouse, for SQL users.

Same answers as ``plans.analytics``, written the same Spark-first way: the
top-k is taken before the rank, streaks are islands of consecutive days, and
the heat map adds the fact up per date and hour before it meets the
dimensions.  Views live in the session's catalog: with Spark's default
in-memory catalog they end with the process.
"""

from __future__ import annotations

from hourglass.functions.clock import HOUR_RANGE_LABELS
from hourglass.sources.warehouse import Warehouse


def _top(fact: str, k: int) -> str:
    return f"""
SELECT committer_email, sum_count, CAST(RANK() OVER (ORDER BY sum_count DESC) AS BIGINT) AS r
FROM (SELECT committer_email, CAST(SUM(commit_count) AS BIGINT) AS sum_count
      FROM {fact} GROUP BY committer_email
      ORDER BY sum_count DESC, committer_email ASC NULLS FIRST LIMIT {int(k)})"""


def _streak(fact: str) -> str:
    return f"""
WITH best AS (
  SELECT committer_email, MAX(run) AS longest_streak
  FROM (SELECT committer_email, island, COUNT(*) AS run
        FROM (SELECT committer_email,
                     date_sub(dt, ROW_NUMBER() OVER (PARTITION BY committer_email ORDER BY dt)) AS island
              FROM (SELECT DISTINCT committer_email, dt FROM {fact}))
        GROUP BY committer_email, island)
  GROUP BY committer_email)
SELECT committer_email, longest_streak FROM best
WHERE longest_streak = (SELECT MAX(longest_streak) FROM best)"""


def _cells(value: str) -> str:
    return ",\n  ".join(
        f"CAST(COALESCE(SUM({value}) FILTER (WHERE hour_range_str = '{x}'), 0) AS BIGINT) AS `{x}`" for x in HOUR_RANGE_LABELS)


def _heat(fact: str, d_date: str, d_time: str, distinct: bool) -> str:
    # The form that drops equal rows needs every single count; the other one only their sum per date and hour.
    counts = (f"SELECT DISTINCT d_date_id, d_time_id, commit_count FROM {fact}" if distinct else
              f"SELECT d_date_id, d_time_id, SUM(commit_count) AS commit_count FROM {fact} GROUP BY d_date_id, d_time_id")
    rows = f"""SELECT weekday, weekday_number, hour_range_str, commit_count
      FROM ({counts}) AS c LEFT JOIN {d_date} USING (d_date_id) LEFT JOIN {d_time} USING (d_time_id)"""
    if distinct:
        rows += "\n      GROUP BY weekday, weekday_number, hour_range_str, commit_count"
    return f"""
SELECT weekday,
  {_cells('commit_count')}
FROM ({rows})
GROUP BY weekday, weekday_number ORDER BY weekday_number ASC NULLS FIRST"""


def create_views(wh: Warehouse, k: int = 5) -> list[str]:
    """Create (or replace) the views in the warehouse database; returns their names.

    ``heat_map`` uses the warehouse's d_time labels; ``heat_map_distinct``
    drops equal counts in a cell before summing.
    """
    fact, d_date, d_time = wh.name("f_commits_hourly"), wh.name("d_date"), wh.name("d_time")
    views = {
        "top_committers": _top(fact, k),
        "committer_longest_streak": _streak(fact),
        "heat_map": _heat(fact, d_date, d_time, distinct=False),
        "heat_map_distinct": _heat(fact, d_date, d_time, distinct=True),
    }
    for name, body in views.items():
        wh.spark.sql(f"CREATE OR REPLACE VIEW {wh.name(name)} AS {body}")
    return list(views)
