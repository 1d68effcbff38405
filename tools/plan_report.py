"""Executed-plan summary of the headline plans (the README's "Plans at a glance").

    python tools/plan_report.py [sf_dir]

Lands the events as bronze below ``spark.checkpoint.dir``, runs a range run,
executes Q1-Q3 and the fact upsert on the written tables and prints, from each
final adaptive plan: shuffle stages, broadcasts, reused exchanges, top-k and
join types, and the partition filters of its scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from hourglass.functions.clock import local_day  # noqa: E402
from hourglass.operators.facts import hourly_fact_by_key  # noqa: E402
from hourglass.operators.merge import upsert_fact  # noqa: E402
from hourglass.plans import analytics  # noqa: E402
from hourglass.plans.backfill import run_days  # noqa: E402
from hourglass.session import get_session, scratch_path  # noqa: E402
from hourglass.sources.events import events_as_bronze, read_events  # noqa: E402
from hourglass.sources.landed import land_bronze  # noqa: E402
from hourglass.sources.warehouse import Warehouse  # noqa: E402


def summary(plan: str) -> str:
    final = plan.split("== Initial Plan ==")[0]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", final)
    filters = sorted(set(re.findall(r"PartitionFilters: \[([^\]]+)\]", final)))
    return (f"shuffle stages={final.count('ShuffleQueryStage')}, "
            f"broadcasts={final.count('BroadcastExchange')}, reused={final.count('Reused')}, "
            f"top-k={'TakeOrderedAndProject' in final}, joins={joins}, partition filters={filters}")


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "plans")
    events = read_events(spark, sf_dir)
    land_bronze(events_as_bronze(events, "dirty").withColumn("dt", local_day(F.col("ts"))), f"{root}/bronze")
    r = events.agg(F.min(local_day(F.col("ts"))).alias("a"), F.max(local_day(F.col("ts"))).alias("b")).first()
    first, last = r["a"], r["b"]
    wh = Warehouse(spark, f"{root}/wh", "plan_report_" + root.rsplit("-", 1)[-1]).create()
    run_days(wh, first, last, bronze_root=f"{root}/bronze", layout="lines")
    fact = wh.table("f_commits_hourly")
    plans = {
        "Q1 top committers": analytics.top_committers(fact),
        "Q2 longest streak": analytics.committers_longest_streak(fact),
        "Q3 heat map": analytics.weekday_hour_heatmap(fact, wh.table("d_date"), wh.table("d_time")),
        "fact upsert": upsert_fact(wh.days("f_commits_hourly", first, last),
                                   hourly_fact_by_key(wh.days("staging_commits", first, last)),
                                   first, last, source_combined=True),
    }
    for name, df in plans.items():
        df.collect()
        print(f"{name}: {summary(df._jdf.queryExecution().executedPlan().toString())}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
