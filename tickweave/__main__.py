"""Command line over the Spark entry points (run with spark-submit or python -m).

    python -m tickweave plan     --catalog C --as-of 2026-03-01T12:00 [--pairs EURUSD ...] [--max-hours N] [--retry-errors]
    python -m tickweave ingest   --raw R --store S --catalog C [--log L]
    python -m tickweave stream   --raw R --store S --catalog C --checkpoint K [--max-files N]
    python -m tickweave status   --catalog C [--store S --raw R]
    python -m tickweave validate --store S [--out PATH]
    python -m tickweave storage  --store S --raw R
    python -m tickweave compact  --store S [--min-files 16]

Fetching from the network is outside this tool: files landed under the raw
root are its input (see README). Output tables are printed with ``show``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession


def _as_of(text: str | None) -> dt.datetime:
    if not text:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t = dt.datetime.fromisoformat(text)
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tickweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("plan", help="slots a run would fetch next, in fetch order")
    p.add_argument("--catalog", required=True)
    p.add_argument("--as-of")
    p.add_argument("--pairs", nargs="*")
    p.add_argument("--max-hours", type=int)
    p.add_argument("--retry-errors", action="store_true")
    p.add_argument("--raw-root", default="raw")
    p.add_argument("--show", type=int, default=50)
    for name in ("ingest", "stream"):
        q = sub.add_parser(name, help=f"{name} landed tick files into the bar store and catalog")
        q.add_argument("--raw", required=True)
        q.add_argument("--store", required=True)
        q.add_argument("--catalog", required=True)
        q.add_argument("--pairs", nargs="*")
        q.add_argument("--log", help="landing log (Parquet: pair, slot, http_status, n_bytes)")
        q.add_argument("--retry-errors", action="store_true", help="ingest: read again what is not fetched")
        if name == "stream":
            q.add_argument("--checkpoint", required=True)
            q.add_argument("--max-files", type=int, default=1000)
    s = sub.add_parser("status", help="per-pair slot counts and totals")
    s.add_argument("--catalog", required=True)
    s.add_argument("--store")
    s.add_argument("--raw")
    v = sub.add_parser("validate", help="data-quality report over the stored bars")
    v.add_argument("--store", required=True)
    v.add_argument("--out")
    c = sub.add_parser("compact", help="rewrite store partitions that accumulated many files")
    c.add_argument("--store", required=True)
    c.add_argument("--min-files", type=int, default=16)
    g = sub.add_parser("storage", help="bytes of the bar store and raw files")
    g.add_argument("--store")
    g.add_argument("--raw")
    args = ap.parse_args(argv)

    from . import api
    from .session import ensure_utc

    spark = ensure_utc(SparkSession.builder.appName(f"tickweave-{args.cmd}").getOrCreate())
    log = spark.read.parquet(args.log) if getattr(args, "log", None) else None
    if args.cmd == "plan":
        cat = api.read_catalog(spark, args.catalog)
        wl = api.plan_worklist(spark, cat, _as_of(args.as_of), args.pairs, args.max_hours,
                               args.retry_errors, raw_root=args.raw_root, maps=api.read_hour_maps(spark, args.catalog))
        wl.orderBy("position").show(args.show, truncate=False)
    elif args.cmd == "ingest":
        res = api.ingest(spark, args.raw, args.store, args.catalog, pairs=args.pairs, landing_log=log, retry_errors=args.retry_errors)
        print(f"slots {res.slots}  errors {res.errors}  new bars {res.merge.new_bars}  "
              f"partitions {len(res.merge.partitions)}  files {res.files}  left alone {res.skipped}  "
              f"paths without a slot {res.unplaced}  with trailing bytes {res.trailing}")
        res.outcomes.where("error IS NOT NULL OR trailing > 0").select("path", "status", "records", "trailing", "error").show(50, truncate=False)
    elif args.cmd == "stream":
        api.incremental_load(spark, args.raw, args.store, args.checkpoint, args.catalog,
                             max_files_per_trigger=args.max_files, pairs=args.pairs, landing_log=log)
    elif args.cmd == "status":
        api.status_report(spark, args.catalog).orderBy("is_total", "pair").show(truncate=False)
        api.progress_totals(spark, args.catalog, args.store, args.raw).show(truncate=False)
    elif args.cmd == "validate":
        rep = api.validate(spark, args.store)
        if args.out:
            api.save_qa_report(rep, args.out)
        api.qa_report_json(rep).orderBy("pair").show(truncate=120)
    elif args.cmd == "compact":
        print("compacted", api.compact_store(spark, args.store, args.min_files))
    elif args.cmd == "storage":
        api.storage_usage(spark, args.store, args.raw).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
