"""Command line for scheduled runs (``spark-submit``-friendly).

    python -m hourglass run   --root s3://bucket/commits --db commits --first 2024-08-01 --last 2025-02-01
    python -m hourglass views --root s3://bucket/commits --db commits

``run`` re-runs business days first..last end to end (both default to
yesterday's business day, for a daily schedule); ``views`` (re)creates the SQL
views of the analyst questions.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from hourglass.functions.clock import LOCAL_OFFSET_HOURS
from hourglass.session import get_session


def _yesterday(offset_hours: int) -> _dt.date:
    now_local = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None) + _dt.timedelta(hours=offset_hours)
    return now_local.date() - _dt.timedelta(days=1)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="hourglass")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "views"):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True, help="warehouse root folder")
        p.add_argument("--db", default="hourglass", help="catalog database")
        p.add_argument("--master", default=None, help="Spark master (leave unset under spark-submit)")
    r = sub.choices["run"]
    r.add_argument("--first", type=_dt.date.fromisoformat)
    r.add_argument("--last", type=_dt.date.fromisoformat)
    r.add_argument("--bronze", default=None, help="bronze root (default <root>/bronze/commits)")
    r.add_argument("--layout", choices=("array", "lines"), required=True)
    r.add_argument("--mode", choices=("strict", "lenient"), default="strict")
    r.add_argument("--rejects", default=None, help="reject folder (lenient mode)")
    r.add_argument("--offset-hours", type=int, default=LOCAL_OFFSET_HOURS)
    r.add_argument("--on-duplicate", choices=("combine", "error"), default="combine")
    r.add_argument("--no-silver", action="store_true")
    args = ap.parse_args(argv)

    from hourglass.sources.warehouse import Warehouse
    spark = get_session(args.master)
    if args.cmd == "views" and spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        ap.error("views need a persistent catalog (e.g. spark.sql.catalogImplementation=hive): "
                 "in the in-memory catalog they end with this process")
    wh = Warehouse(spark, args.root, args.db).create()
    if args.cmd == "views":
        from hourglass.plans.views import create_views
        print(json.dumps({"views": create_views(wh)}))
        return 0
    from hourglass.plans.backfill import run_days
    first = args.first or _yesterday(args.offset_hours)
    last = args.last or first
    res = run_days(wh, first, last, bronze_root=args.bronze, layout=args.layout, mode=args.mode,
                   offset_hours=args.offset_hours, on_duplicate=args.on_duplicate,
                   write_silver=not args.no_silver, reject_root=args.rejects)
    print(json.dumps({"first": str(first), "last": str(last),
                      "days": {t: len(ds) for t, ds in res.days.items()},
                      "empty_days": {t: [str(d) for d in ds] for t, ds in res.empty_days.items()}}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
