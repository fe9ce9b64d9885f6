"""Command line: the same runs the source scripts offer, as Spark jobs.

    python -m yieldspark.cli ingest  --drop DIR --log LOG --checkpoint CKPT [--kind workstation|testboard|snfn]
    python -m yieldspark.cli daily   --log LOG --out OUT [--testboard TB] [--mode all|recent --as-of D] [--incremental]
    python -m yieldspark.cli weekly  --log LOG --out OUT [--testboard TB] [--mode all|recent --as-of D]
    python -m yieldspark.cli chain   --logs DIR --out OUT --as-of D [--drop KIND=DIR ...] [--weekly]
    python -m yieldspark.cli dedup   --log LOG --to NEW_LOG [--kind workstation]
    python -m yieldspark.cli report  --log LOG --out OUT --as-of D

Drop directories may hold CSV, Parquet and workbook files with any column
order; rejected rows go to the folder ``LOG_quarantine``. ``recent`` needs
``--as-of``. ``--now`` is the run time written to the tables (the clock is
read here only, if it is not given). ``LOG`` is a Parquet log written by
``ingest`` (partitioned by end date). Master, shuffle partitions and
``spark.checkpoint.dir`` are those of spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from . import schemas, session
from .plans import jobs


def _date(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="yieldspark")
    p.add_argument("--now", type=_dt.datetime.fromisoformat)
    p.add_argument("--master")
    p.add_argument("--shuffle-partitions", type=int)
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest", help="import every report in a drop directory into a log (once)")
    i.add_argument("--drop", required=True)
    i.add_argument("--log", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--kind", default="workstation", choices=sorted(schemas.LOGS))
    i.add_argument("--file-atomic", action="store_true", help="one bad row rejects its whole file")
    for name in ("daily", "weekly"):
        j = sub.add_parser(name)
        j.add_argument("--log", required=True)
        j.add_argument("--out", required=True)
        j.add_argument("--testboard")
        j.add_argument("--mode", default="all", choices=["all", "recent"])
        j.add_argument("--as-of", type=_date)
        if name == "daily":
            j.add_argument("--incremental", action="store_true")
    c = sub.add_parser("chain", help="the daily (or weekly) chain over all logs")
    c.add_argument("--logs", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--as-of", type=_date, required=True)
    c.add_argument("--drop", action="append", default=[], help="KIND=DIR")
    c.add_argument("--weekly", action="store_true")
    d = sub.add_parser("dedup", help="keep the first row of every business key (new log folder)")
    d.add_argument("--log", required=True)
    d.add_argument("--to", required=True)
    d.add_argument("--kind", default="workstation", choices=sorted(schemas.LOGS))
    r = sub.add_parser("report")
    r.add_argument("--log", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--as-of", type=_date, required=True)
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = build_parser().parse_args(argv)
    spark = spark or session.build(args.master, args.shuffle_partitions, app=f"yieldspark-{args.cmd}")
    now = args.now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if getattr(args, "mode", None) == "recent" and args.as_of is None:
        raise SystemExit("--mode recent needs --as-of")
    as_of = args.as_of if getattr(args, "mode", None) == "recent" else None
    tb = spark.read.parquet(args.testboard) if getattr(args, "testboard", None) else None
    if args.cmd == "ingest":
        from .streaming import stream
        total: dict[str, int] = {}

        def add(_batch: int, n: dict[str, int]) -> None:
            for k, v in n.items():
                total[k] = total.get(k, 0) + v

        stream.start_report_ingest(spark, args.drop, args.log, args.checkpoint, kind=args.kind, on_batch=add, now=now,
                                   file_atomic=args.file_atomic).awaitTermination()
        log = jobs.LogStore(spark, args.log, schemas.LOGS[args.kind][1]).read()
        out = {**total, "rows_in_log": log.count() if log is not None else 0}
    elif args.cmd == "daily":
        out = jobs.daily(spark, spark.read.parquet(args.log), args.out, now, tb=tb, as_of=as_of,
                         incremental=args.incremental)
    elif args.cmd == "weekly":
        out = jobs.weekly(spark, spark.read.parquet(args.log), args.out, now, as_of=as_of, tb=tb)
    elif args.cmd == "chain":
        if args.weekly:
            out = jobs.weekly_chain(spark, args.logs, args.out, args.as_of, now)
        else:
            drops = dict(d.split("=", 1) for d in args.drop)
            out = jobs.daily_chain(spark, drops, args.logs, args.out, args.as_of, now)
    elif args.cmd == "dedup":
        log = spark.read.parquet(args.log)
        jobs.dedup_copy(log, args.to, args.kind)
        out = {"before": log.count(), "after": spark.read.parquet(args.to).count()}
    else:
        rep = jobs.report(spark, spark.read.parquet(args.log), None, args.out, args.as_of)
        out = {r.table_name: r.asDict() for r in rep.collect()}  # one row per table
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
