"""Command-line jobs, the counterpart of the reference's job scripts.

    python -m tidepool medallion --raw DIR --root DIR
    python -m tidepool ingest --events DIR --table DIR --checkpoint DIR [--once]
    python -m tidepool history --table DIR [--limit N]

On a cluster run them through ``spark-submit`` (the session comes from the
submitter); ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import sys


def _session(args):
    from tidepool.session import build, tune
    return tune(build(master=args.master, app_name=f"tidepool-{args.cmd}"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidepool")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("medallion", help="raw CSV → bronze → silver → gold, then layer counts")
    m.add_argument("--raw", required=True)
    m.add_argument("--root", required=True)
    i = sub.add_parser("ingest", help="order events → Parquet table and quarantine (exactly once)")
    i.add_argument("--events", required=True, help="directory of JSON-lines files")
    i.add_argument("--kafka-servers", default=None)
    i.add_argument("--topic", default="orders")
    i.add_argument("--table", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--quarantine", default=None, help="invalid events (default: TABLE_rejected)")
    i.add_argument("--trigger", default="5 seconds")
    i.add_argument("--once", action="store_true", help="process what is there, then stop")
    h = sub.add_parser("history", help="versions of a snapshot table")
    h.add_argument("--table", required=True)
    h.add_argument("--limit", type=int, default=None, help="show only the newest N versions")
    args = p.parse_args(argv)

    spark = _session(args)
    from tidepool.tables import snapshots as T
    try:
        return _run(spark, args, T)
    except (T.TableError, T.SchemaMismatch) as e:
        print(f"tidepool {args.cmd}: {e}", file=sys.stderr)
        return 2


def _run(spark, args, T) -> int:
    from pyspark.sql import functions as F
    if args.cmd == "medallion":
        from tidepool import medallion as M
        paths = M.run(spark, args.raw, args.root)
        M.reconcile(spark, {k: v for k, v in paths.items() if k != "quarantine"}, args.raw).show()
    elif args.cmd == "ingest":
        from tidepool.streaming.events import read_events
        from tidepool.streaming.ingest import await_or_stop, read_ingested, rejected_path, run_ingest
        src = read_events(spark, path=args.events, kafka_servers=args.kafka_servers, topic=args.topic)
        q = run_ingest(spark, src, args.table, args.checkpoint, quarantine_path=args.quarantine,
                       processing_time=args.trigger, available_now=args.once)
        await_or_stop(q)
        rejected = rejected_path(args.table, args.quarantine)
        print(f"rows in the table: {read_ingested(spark, args.table).count()}, "
              f"rejected: {read_ingested(spark, rejected).count()}")
    elif args.cmd == "history":
        log = T.history(spark, args.table).orderBy(F.col("version").desc())
        n = log.count()
        log.show(args.limit or n, truncate=False)
        print(f"{n} versions")
    return 0


if __name__ == "__main__":
    sys.exit(main())
