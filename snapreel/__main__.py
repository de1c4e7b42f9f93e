"""Command line: ``python -m snapreel {daily,build,test,sql,route} ...``.

* ``daily`` -- one daily run: route/fetch/replay the trending snapshot of
  ``--date``, enrich missing details and credits from landing folders,
  refresh the marts and run all checks (``--scoped-checks`` runs them on what
  the run changed). Fails when latest keys lack details or credits, unless
  ``--allow-incomplete`` is given.
* ``build`` -- rebuild the marts from the raw tables and run the checks.
* ``test`` -- run all checks against the stored marts (no rebuild).
* ``sql`` -- run a SQL statement with every raw table and model registered
  as a view under its name (``dim_content``, ``stg_tmdb_trending``, ...).
* ``route`` -- print the replay/fetch/fail routing for a range of dates.

Exit status 1 when a data-quality check fails (or a date cannot be routed).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from snapreel.operators import quality as Q
from snapreel.operators.replay import SnapshotMissingError, date_range, route_snapshots, utc_today
from snapreel.plans import daily as D
from snapreel.session import build_session
from snapreel.sources import snapshots as SN
from snapreel.sources import versions as VT


def _report(not_null, unique) -> int:
    bad_nn = Q.failures(not_null, "failing_rows")
    bad_u = Q.failures(unique, "failing_groups")
    n = bad_nn.count() + bad_u.count()
    print(f"data-quality checks failing: {n}")
    if n:
        bad_nn.show(truncate=False)
        bad_u.show(truncate=False)
    return 1 if n else 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="snapreel", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--store", required=True)
    d.add_argument("--raw", required=True)
    d.add_argument("--marts", required=True)
    d.add_argument("--date", default=None)
    d.add_argument("--today", default=None)
    for s in ("trending", "details", "credits"):
        d.add_argument(f"--{s}-landing", default=None)
    d.add_argument("--media-type-from", default="envelope", choices=["envelope", "item"])
    d.add_argument("--scoped-checks", action="store_true", help="check only what the run changed")
    d.add_argument("--allow-incomplete", action="store_true",
                   help="build the marts although latest keys lack details or credits")
    d.add_argument("--database", default=None, help="schema in which the run names its tables (default: one of the marts folder's own)")
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--marts", required=True)
    b.add_argument("--media-type-from", default="envelope", choices=["envelope", "item"])
    t = sub.add_parser("test")
    t.add_argument("--raw", required=True)
    t.add_argument("--marts", required=True)
    t.add_argument("--media-type-from", default="envelope", choices=["envelope", "item"])
    q = sub.add_parser("sql")
    q.add_argument("--raw", required=True)
    q.add_argument("--marts", default=None)
    q.add_argument("--media-type-from", default="envelope", choices=["envelope", "item"])
    q.add_argument("--rows", type=int, default=20, help="rows to print")
    q.add_argument("statement")
    r = sub.add_parser("route")
    r.add_argument("--store", required=True)
    r.add_argument("--from", dest="start", required=True)
    r.add_argument("--to", dest="end", required=True)
    r.add_argument("--today", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.cmd == "route":
        req = date_range(spark, F.to_date(F.lit(args.start)), F.to_date(F.lit(args.end)))
        inv = SN.snapshot_inventory(spark, args.store, "trending")
        routes = route_snapshots(req, inv, args.today or utc_today()).orderBy("requested_date")
        routes.show(routes.count(), truncate=False)
        return 1 if routes.where(F.col("action") == "fail").first() else 0
    if args.cmd in ("test", "sql"):
        by_name = "raw" if args.cmd == "sql" else None          # raw.tmdb_trending_raw and the others resolve in SQL
        raw = {s: D.read_raw(spark, args.raw, s, by_name) for s in ("trending", "details", "credits")}
        models = D.build_models(raw["trending"], raw["details"], raw["credits"], args.media_type_from)
        if args.marts and args.cmd == "sql":
            D.attach_marts(spark, args.marts, "marts")
        if args.marts:
            for name in D.MART_MODELS:
                path = f"{args.marts.rstrip('/')}/{name}"
                if VT.exists(spark, path):
                    models[name] = VT.read(spark, path)
        models.update({f"tmdb_{s}_raw": df for s, df in raw.items()})
        if args.cmd == "sql":
            D.register_views(models)
            spark.sql(args.statement).show(args.rows, truncate=False)
            return 0
        checked = {**models, "tmdb_details_raw": raw["details"].drop("payload"),
                   "tmdb_credits_raw": raw["credits"].drop("payload")}
        return _report(Q.run_not_null(checked), Q.run_unique(checked))
    if args.cmd == "build":
        raw = {s: D.read_raw(spark, args.raw, s) for s in ("trending", "details", "credits")}
        models = D.materialize_marts(spark, D.build_models(raw["trending"], raw["details"], raw["credits"],
                                                          args.media_type_from), args.marts)
        checked = {**models, "tmdb_details_raw": raw["details"].drop("payload"),
                   "tmdb_credits_raw": raw["credits"].drop("payload")}
        return _report(Q.run_not_null(checked), Q.run_unique(checked))
    land = {s: (SN.read_documents(spark, getattr(args, f"{s}_landing"))
                if getattr(args, f"{s}_landing") else None) for s in ("trending", "details", "credits")}
    run_date = args.date or utc_today()
    try:
        res = D.run_daily(spark, args.store, args.raw, args.marts, run_date, args.today or utc_today(),
                          land["trending"], land["details"], land["credits"], args.media_type_from,
                          scoped_checks=args.scoped_checks, allow_incomplete=args.allow_incomplete, database=args.database)
    except (SnapshotMissingError, D.RawIncompleteError) as e:
        print(str(e), file=sys.stderr)
        return 1
    res.routes.show(truncate=False)
    res.gate.show(truncate=False)
    return _report(res.not_null, res.unique)


if __name__ == "__main__":
    sys.exit(main())
