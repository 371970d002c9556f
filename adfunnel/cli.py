r"""Command line for the jobs: one verb per job of the original scripts.

    python -m adfunnel.cli load-hour FILE --ug-from 1 --ug-to 128 --events PATH
    python -m adfunnel.cli load-day 2024-01-05 --landing ROOT --shard s1 --ug-from 1 --ug-to 128 --events PATH
    python -m adfunnel.cli backfill 2024-01-20 --landing ROOT --shard s1 --ug-from 1 --ug-to 256 --events PATH \
        --ssp PATH --out PATH [--days 13]
    python -m adfunnel.cli build-day 2024-01-05 --events PATH --ssp PATH --out PATH [--no-gate] [--lookahead]
    python -m adfunnel.cli need-fill --table PATH [--cap 21]       exit 0: add more, 1: full
    python -m adfunnel.cli retention --table PATH [--keep 14]
    python -m adfunnel.cli excise --table PATH FIRST [LAST]
    python -m adfunnel.cli load-ssp TEXT --table PATH [--date yyyy-mm-dd]
    python -m adfunnel.cli create-tables --database DB --location LOC
    python -m adfunnel.cli drop-table --database DB --table NAME

The loads also take --rejects PATH (default EVENTS_rejects) and --cluster-partitions N.
Runs on the session of ``spark-submit`` (or a local one when started directly).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _day(text: str) -> dt.date:
    from .plans.lifecycle import parse_day
    return parse_day(text)


def _load_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--rejects")
    p.add_argument("--cluster-partitions", type=int)


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="adfunnel")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("load-hour")
    p.add_argument("file")
    p.add_argument("--ug-from", type=int, required=True)
    p.add_argument("--ug-to", type=int, required=True)
    p.add_argument("--events", required=True)
    _load_options(p)

    p = sub.add_parser("load-day")
    p.add_argument("day", type=_day)
    p.add_argument("--landing", required=True)
    p.add_argument("--shard", required=True)
    p.add_argument("--ug-from", type=int, required=True)
    p.add_argument("--ug-to", type=int, required=True)
    p.add_argument("--events", required=True)
    _load_options(p)

    p = sub.add_parser("backfill")
    p.add_argument("today", type=_day)
    p.add_argument("--landing", required=True)
    p.add_argument("--shard", required=True)
    p.add_argument("--ug-from", type=int, required=True)
    p.add_argument("--ug-to", type=int, required=True)
    p.add_argument("--events", required=True)
    p.add_argument("--ssp", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--days", type=int, default=13)
    p.add_argument("--repair-late", action="store_true", help="repair days from their late hours instead of building them anew")
    _load_options(p)

    p = sub.add_parser("build-day")
    p.add_argument("day", type=_day)
    p.add_argument("--events", required=True)
    p.add_argument("--ssp", required=True, help="SSP site table (parquet: sid, name, d)")
    p.add_argument("--out", required=True)
    p.add_argument("--no-gate", action="store_true")
    p.add_argument("--lookahead", action="store_true")

    p = sub.add_parser("need-fill")
    p.add_argument("--table", required=True)
    p.add_argument("--cap", type=int, default=21)

    p = sub.add_parser("retention")
    p.add_argument("--table", required=True)
    p.add_argument("--keep", type=int, default=14)

    p = sub.add_parser("excise")
    p.add_argument("--table", required=True)
    p.add_argument("first")
    p.add_argument("last", nargs="?")

    p = sub.add_parser("load-ssp")
    p.add_argument("text")
    p.add_argument("--table", required=True)
    p.add_argument("--date", type=_day)

    p = sub.add_parser("create-tables")
    p.add_argument("--database", required=True)
    p.add_argument("--location", required=True)

    p = sub.add_parser("drop-table")
    p.add_argument("--database", required=True)
    p.add_argument("--table", required=True)
    return ap


def run(spark: SparkSession, argv: list[str]) -> tuple[int, object]:
    """Execute one command; returns (exit code, result)."""
    from .plans import daily, ingest, lifecycle
    from .sources import ssp, tables

    a = _parser().parse_args(argv)
    if a.cmd == "load-hour":
        return 0, ingest.load_hour_file(spark, a.file, a.ug_from, a.ug_to, a.events,
                                        a.cluster_partitions, a.rejects)
    if a.cmd == "load-day":
        return 0, ingest.load_day_batched(spark, a.landing, a.day, a.shard, a.ug_from, a.ug_to, a.events,
                                          a.cluster_partitions, a.rejects)
    if a.cmd == "backfill":
        def load_day(day):
            return ingest.load_day_batched(spark, a.landing, day, a.shard, a.ug_from, a.ug_to, a.events,
                                           a.cluster_partitions, a.rejects)
        done = daily.backfill(spark, a.today, load_day, a.events, a.out, spark.read.parquet(a.ssp), a.days,
                              repair_late=a.repair_late)
        return 0, [(str(d), what) for d, what in done]
    if a.cmd == "build-day":
        try:
            daily.build_day(spark, a.events, spark.read.parquet(a.ssp), a.day, a.out,
                            require_complete=not a.no_gate, require_lookahead=a.lookahead)
        except daily.IncompleteDay as e:
            return 1, str(e)
        return 0, "built"
    if a.cmd == "need-fill":
        need = lifecycle.path_needs_fill(spark, a.table, a.cap)
        return (0 if need else 1), need
    if a.cmd == "retention":
        return 0, [str(d) for d in lifecycle.apply_retention(spark, a.table, a.keep)]
    if a.cmd == "excise":
        return 0, lifecycle.excise_days(spark, a.table, a.first, a.last)
    if a.cmd == "load-ssp":
        return 0, ssp.load_sites(spark, a.text, a.table, a.date)
    if a.cmd == "create-tables":
        tables.create_tables(spark, a.database, a.location)
        return 0, "ok"
    if a.cmd == "drop-table":
        tables.drop_table(spark, a.database, a.table)
        return 0, "ok"
    raise AssertionError(a.cmd)


def main(argv: list[str] | None = None) -> int:
    spark = SparkSession.getActiveSession()
    if spark is None:
        from .session import build_session
        spark = build_session()
    code, result = run(spark, list(sys.argv[1:] if argv is None else argv))
    print(json.dumps(result, default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
