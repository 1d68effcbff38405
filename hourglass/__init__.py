"""hourglass: commit-activity analytics as Spark DataFrame plans.

Raw commit records land as JSON, are normalised into a fixed schema, shifted
to a local business day and kept in day-partitioned layers that can be re-run
for any date range.  From them a date dimension, an hour-of-day dimension and
an hourly fact table are maintained with merge semantics on plain Parquet, and
three analyst questions are answered: top committers, longest day streaks and a
weekday-by-hour heat map.

Layout:
  functions/  column expressions (time parsing, local day, date keys, labels)
  sources/    schemas, landed JSON layers, warehouse tables, test-data adapter
  operators/  DataFrame -> DataFrame building blocks (normalise, dims, fact,
              merge, checks, ranking, streaks, heat map)
  plans/      end-to-end plans: range runs and the registered queries
  streaming/  file-arrival trigger that re-runs the touched days
"""

from hourglass.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
