"""DuckDB text for every registered query, over the driver's raw tables.

The events -> commit mapping of ``sources.events`` is inlined as CTEs, so the
oracle shares no code with the Spark plans.  Column names and types match the
Spark results (sums cast to BIGINT, counts are BIGINT in both engines).
"""

from __future__ import annotations

TS_FMT = "'%Y-%m-%dT%H:%M:%SZ'"

EMAIL = {
    "fine": "'u' || CAST(user_id AS VARCHAR) || '@example.com'",
    "coarse": "event_type || '@example.com'",
    "dirty": ("CASE WHEN event_id % 97 = 0 THEN NULL "
              "ELSE event_type || CAST(user_id % 7 AS VARCHAR) || '@example.com' END"),
}

# the run's first day: the middle day of the table
RUN = """run AS (
  SELECT min(d) + CAST(floor((max(d) - min(d)) / 2) AS INTEGER) AS day
  FROM (SELECT CAST(date_trunc('second', ts) + INTERVAL 7 HOUR AS DATE) AS d FROM events))"""


def commits_cte(email: str, name: str = "commits", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT CAST(event_id AS VARCHAR) AS commit_sha,
         CAST(CASE WHEN event_id % 11 = 0 THEN -1 ELSE user_id % 7 END AS BIGINT) AS committer_id,
         'user' || CAST(user_id AS VARCHAR) AS committer_name,
         {EMAIL[email]} AS committer_email,
         strftime(ts, {TS_FMT}) AS committer_date,
         CAST(date_trunc('second', ts) + INTERVAL 7 HOUR AS DATE) AS dt,
         ts
  FROM events WHERE {where})"""


def fact_cte(src: str = "commits", name: str = "fact") -> str:
    return f"""{name} AS (
  SELECT CAST(strftime(dt, '%Y%m%d') AS BIGINT) AS d_date_id,
         CAST(extract(hour FROM strptime(committer_date, {TS_FMT}) + INTERVAL 7 HOUR) AS BIGINT) AS d_time_id,
         committer_id, committer_email, COUNT(*) AS commit_count, dt
  FROM {src}
  GROUP BY 1, 2, committer_id, committer_email, dt)"""


def combined_cte(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT d_date_id, d_time_id, MAX(committer_id) AS committer_id, committer_email,
         CAST(SUM(commit_count) AS BIGINT) AS commit_count, dt
  FROM {src} GROUP BY d_date_id, d_time_id, committer_email, dt)"""


def d_date_cte(src: str = "commits", name: str = "d_date") -> str:
    return f"""{name} AS (
  SELECT CAST(strftime(dt, '%Y%m%d') AS BIGINT) AS d_date_id,
         strftime(dt, '%Y-%m-%d') AS date_str,
         dayname(dt) AS weekday,
         CAST(isodow(dt) AS BIGINT) AS weekday_number,
         dt
  FROM (SELECT DISTINCT dt FROM {src}))"""


D_TIME_3H = """d_time AS (
  SELECT CAST(h AS BIGINT) AS d_time_id,
         CASE WHEN h = 0 OR h >= 22 THEN '22-00'
              ELSE printf('%02d-%02d', ((h - 1) // 3) * 3 + 1, ((h - 1) // 3) * 3 + 3) END AS hour_range_str
  FROM range(24) AS r(h))"""

D_TIME_LITERAL = """d_time AS (
  SELECT CAST(h AS BIGINT) AS d_time_id,
         printf('%02d-%02d',
                CASE WHEN h = 0 THEN 22 ELSE CAST(round(((h - 1) / 3) * 3 + 1) AS BIGINT) END,
                CASE WHEN h = 0 THEN 0 ELSE CAST(round(((h - 1) / 3) * 3 + 3) AS BIGINT) END) AS hour_range_str
  FROM range(24) AS r(h))"""

LABELS = ("01-03", "04-06", "07-09", "10-12", "13-15", "16-18", "19-21", "22-00")


def hours_sql(d_time_cte: str) -> str:
    return f"""WITH {commits_cte('fine')}, {fact_cte()}, {d_time_cte},
per AS (SELECT d_time_id, SUM(commit_count) AS commit_count FROM fact GROUP BY d_time_id)
SELECT t.d_time_id, t.hour_range_str, CAST(COALESCE(p.commit_count, 0) AS BIGINT) AS commit_count
FROM d_time t LEFT JOIN per p ON t.d_time_id = p.d_time_id"""


def heatmap_sql(d_time_cte: str, distinct: bool, days: str = "TRUE", email: str = "coarse", rows: str = "TRUE") -> str:
    """Each cell as a filtered sum over (day, label, count) rows."""
    cells = ",\n    ".join(
        f"CAST(coalesce(sum(n) FILTER (WHERE label = '{x}'), 0) AS BIGINT) AS \"{x}\"" for x in LABELS)
    return f"""WITH {commits_cte(email)}, {fact_cte()}, {d_date_cte()}, {d_time_cte},
known AS (SELECT d_date_id AS k, weekday, weekday_number FROM d_date WHERE {days}),
counts AS (
  SELECT {'DISTINCT ' if distinct else ''}known.weekday, known.weekday_number, d_time.hour_range_str AS label, fact.commit_count AS n
  FROM fact LEFT JOIN known ON known.k = fact.d_date_id LEFT JOIN d_time USING (d_time_id)
  WHERE {rows})
SELECT weekday,
    {cells}
FROM counts GROUP BY ALL ORDER BY min(weekday_number) NULLS FIRST"""


# Streaks as islands: on a run of consecutive days, the day less its row number is constant.
STREAK_CTES = f"""{commits_cte('fine')}, {fact_cte()},
days AS (SELECT committer_email, dt, sum(commit_count) AS commits FROM fact GROUP BY ALL),
islands AS (
  SELECT committer_email, dt,
         dt - CAST(row_number() OVER (PARTITION BY committer_email ORDER BY dt) AS INTEGER) AS island
  FROM days),
runs AS (
  SELECT committer_email, island, count(*) AS run,
         row_number() OVER (PARTITION BY committer_email ORDER BY island) AS number
  FROM islands GROUP BY committer_email, island)"""


TARGET_COMMITS = f"""{RUN}, {commits_cte('dirty')}, {fact_cte()},
{commits_cte('dirty', 'old_all', 'event_id % 3 <> 0')},
old_commits AS (SELECT old_all.* FROM old_all, run WHERE dt <> run.day + 2),
{commits_cte('dirty', 'new_all', 'event_id % 5 <> 0')},
new_commits AS (SELECT new_all.* FROM new_all, run WHERE dt BETWEEN run.day AND run.day + 2 AND dt <> run.day + 1)"""

FACT_COLUMNS = "d_date_id, d_time_id, committer_id, committer_email, commit_count, dt"


def merge_fact_sql(delete_zero: bool) -> str:
    """The merge as three disjoint parts: what stays, what the source brings, what it lacks."""
    zeroed = "" if delete_zero else """
UNION ALL
SELECT d_date_id, d_time_id, committer_id, committer_email, CAST(0 AS BIGINT) AS commit_count, dt FROM tgt, run
WHERE dt BETWEEN run.day AND run.day + 2
  AND NOT EXISTS (SELECT 1 FROM src WHERE src.committer_email = tgt.committer_email
                  AND src.d_time_id = tgt.d_time_id AND src.d_date_id = tgt.d_date_id)"""
    return f"""WITH {TARGET_COMMITS},
{fact_cte('old_commits', 'old_fact')}, {combined_cte('old_fact', 'tgt')},
{fact_cte('new_commits', 'new_fact')}, {combined_cte('new_fact', 'src')}
SELECT {FACT_COLUMNS} FROM tgt, run WHERE dt NOT BETWEEN run.day AND run.day + 2
UNION ALL
SELECT d_date_id, d_time_id, coalesce(
         (SELECT max(tgt.committer_id) FROM tgt WHERE tgt.committer_email = src.committer_email
          AND tgt.d_time_id = src.d_time_id AND tgt.d_date_id = src.d_date_id), committer_id) AS committer_id,
       committer_email, commit_count, dt FROM src{zeroed}"""


# events whose record the faulty adapter breaks (see sources.events)
FAULTY = "event_id % 83 = 0 OR event_id % 89 = 0 OR (event_id % 79 = 0 AND event_id % 11 <> 0)"


def reject_sql(more: str = "") -> str:
    return f"""SELECT CAST(event_id AS VARCHAR) AS commit_sha,
       CASE WHEN event_id % 89 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, {TS_FMT}) END
         AS committer_date,
       CASE WHEN event_id % 83 = 0 THEN 'missing_field'
            WHEN event_id % 89 = 0 THEN 'bad_date'
            ELSE 'bad_committer_id' END AS reject_reason{more}
FROM events
WHERE {FAULTY}"""


def window_sql(days: str) -> str:
    return f"""WITH {commits_cte('fine')}
SELECT dt,
       strftime(CAST(dt AS TIMESTAMP) - INTERVAL 7 HOUR, {TS_FMT}) AS api_since,
       strftime(CAST(dt AS TIMESTAMP) + INTERVAL 17 HOUR - INTERVAL 1 SECOND, {TS_FMT}) AS api_until,
       COUNT(*) AS commits
FROM commits WHERE {days} GROUP BY dt"""


def oracle_sql() -> dict[str, str]:
    fine = commits_cte("fine")
    sql = {
        "normalize_commits": f"""WITH {fine}
SELECT commit_sha, committer_id, committer_name, committer_email, committer_date, dt FROM commits""",

        "local_time": f"""WITH {fine}
SELECT commit_sha, committer_date,
       strptime(committer_date, {TS_FMT}) + INTERVAL 7 HOUR AS local_ts,
       CAST(extract(hour FROM strptime(committer_date, {TS_FMT}) + INTERVAL 7 HOUR) AS BIGINT) AS d_time_id,
       dt
FROM commits""",

        "f_commits_hourly": f"""WITH {fine}, {fact_cte()}
SELECT d_date_id, d_time_id, committer_id, committer_email, commit_count, dt FROM fact""",

        "committer_totals": f"""WITH {fine}, {fact_cte()}
SELECT committer_email, CAST(SUM(commit_count) AS BIGINT) AS sum_count FROM fact GROUP BY committer_email""",

        "committer_rank": f"""WITH {fine}, {fact_cte()},
totals AS (SELECT committer_email, CAST(sum(commit_count) AS BIGINT) AS n FROM fact GROUP BY ALL)
SELECT committer_email, n AS sum_count,
       1 + (SELECT count(*) FROM totals AS larger WHERE larger.n > totals.n) AS r FROM totals""",

        "top_committers": f"""WITH {fine}, {fact_cte()},
totals AS (SELECT committer_email, CAST(sum(commit_count) AS BIGINT) AS n FROM fact GROUP BY ALL)
SELECT committer_email, n AS sum_count,
       1 + (SELECT count(*) FROM totals AS larger WHERE larger.n > totals.n) AS r
FROM totals ORDER BY n DESC, committer_email NULLS FIRST LIMIT 5""",

        "d_date": f"""WITH {fine}, {d_date_cte()}
SELECT d_date_id, date_str, weekday, weekday_number, dt FROM d_date""",

        "d_time_3h": hours_sql(D_TIME_3H),
        "d_time_literal": hours_sql(D_TIME_LITERAL),

        "fact_enriched": f"""WITH {commits_cte('coarse')}, {fact_cte()}, {d_date_cte()}, {D_TIME_3H}
SELECT f.d_date_id, f.d_time_id, f.committer_email, f.commit_count, f.dt,
       d.weekday, d.weekday_number, t.hour_range_str
FROM fact f
LEFT JOIN d_date d ON f.d_date_id = d.d_date_id
LEFT JOIN d_time t ON f.d_time_id = t.d_time_id""",

        "fact_enriched_gaps": f"""WITH {commits_cte('coarse')}, {fact_cte()}, {d_date_cte()}, {D_TIME_3H},
known AS (SELECT * FROM d_date WHERE day(dt) % 6 <> 0)
SELECT fact.d_date_id, fact.d_time_id, fact.committer_email, fact.commit_count, fact.dt,
       known.weekday, known.weekday_number, d_time.hour_range_str
FROM fact LEFT JOIN known ON known.d_date_id = fact.d_date_id LEFT JOIN d_time ON d_time.d_time_id = fact.d_time_id""",

        "heatmap": heatmap_sql(D_TIME_3H, distinct=False),
        "heatmap_distinct_3h": heatmap_sql(D_TIME_3H, distinct=True),
        "heatmap_literal": heatmap_sql(D_TIME_LITERAL, distinct=True),
        "heatmap_gaps": heatmap_sql(D_TIME_3H, distinct=False, days="day(dt) % 6 <> 0"),

        "daily_activity": f"""WITH {STREAK_CTES}
SELECT committer_email, dt, CAST(least(commits, 1) AS BIGINT) AS has_commit FROM days""",
        "streak_boundaries": f"""WITH {STREAK_CTES}
SELECT committer_email, dt, CAST(NOT EXISTS (
         SELECT 1 FROM days AS eve WHERE eve.committer_email = days.committer_email AND eve.dt = days.dt - 1) AS BIGINT) AS new_streak
FROM days""",
        "streak_groups": f"""WITH {STREAK_CTES}
SELECT committer_email, dt, number AS streak_group FROM islands JOIN runs USING (committer_email, island)""",
        "streak_lengths": f"WITH {STREAK_CTES}\nSELECT committer_email, number AS streak_group, run AS streak_length FROM runs",
        "longest_streak": f"""WITH {STREAK_CTES}
SELECT DISTINCT committer_email, run AS longest_streak FROM runs WHERE run = (SELECT max(run) FROM runs)""",

        "merge_d_date": f"""WITH {TARGET_COMMITS},
{d_date_cte('old_commits', 'tgt_rows')}, {d_date_cte('new_commits', 'src')},
tgt AS (SELECT * REPLACE (CASE WHEN d_date_id % 2 = 0 THEN 'old ' || weekday ELSE weekday END AS weekday) FROM tgt_rows)
SELECT tgt.* FROM tgt, run WHERE dt NOT BETWEEN run.day AND run.day + 2 OR dt IN (SELECT dt FROM src)
UNION ALL
SELECT * FROM src WHERE dt NOT IN (SELECT dt FROM tgt)""",

        "merge_fact": merge_fact_sql(delete_zero=False),
        "fact_delete_zero": merge_fact_sql(delete_zero=True),

        "merge_error_policy": f"""WITH {TARGET_COMMITS},
{fact_cte('old_commits', 'old_fact')}, {combined_cte('old_fact', 'tgt')}
SELECT {FACT_COLUMNS} FROM tgt, run WHERE dt NOT BETWEEN run.day AND run.day + 2
UNION ALL
SELECT {FACT_COLUMNS} FROM fact, run WHERE dt BETWEEN run.day AND run.day + 2""",

        "local_day_window": window_sql("TRUE"),
        "local_day_window_inner": window_sql(
            "dt BETWEEN (SELECT min(dt) + 4 FROM commits) AND (SELECT max(dt) - 4 FROM commits)"),

        "partition_guard": f"""WITH {commits_cte('dirty')}
SELECT commit_sha, CAST(ts AS DATE) AS landed_dt, dt FROM commits WHERE dt <> CAST(ts AS DATE)""",

        "reject_split": reject_sql(),

        "pk_violations": f"""WITH {fine}, {fact_cte()}
SELECT committer_email, d_time_id, d_date_id, COUNT(*) AS n
FROM fact GROUP BY committer_email, d_time_id, d_date_id HAVING COUNT(*) > 1""",

        "pk_violations_sha": f"""WITH {fine}
SELECT commit_sha, CAST(2 AS BIGINT) AS n FROM commits WHERE CAST(commit_sha AS BIGINT) % 13 = 0""",

        "pk_violations_d_date": f"""WITH {RUN}, {fine}
SELECT DISTINCT CAST(strftime(dt, '%Y%m%d') AS BIGINT) AS d_date_id, CAST(2 AS BIGINT) AS n FROM commits, run WHERE dt >= run.day""",

        "pk_violations_declared": f"""WITH {commits_cte('dirty')}, {fact_cte()}
SELECT committer_email, d_date_id, count(*) AS n FROM fact GROUP BY ALL HAVING n > 1""",

        "fk_orphans": f"""WITH {TARGET_COMMITS}
SELECT {FACT_COLUMNS} FROM fact WHERE dt NOT IN (SELECT dt FROM old_commits)""",

        "fk_orphans_d_time": f"""WITH {commits_cte('dirty')}, {fact_cte()}
SELECT {FACT_COLUMNS} FROM fact WHERE d_time_id IN (0, 6, 12, 18)""",
    }
    from hourglass.plans.files import oracle_sql as file_sql
    sql.update(file_sql())
    return sql
