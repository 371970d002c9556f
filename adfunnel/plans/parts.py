"""Loads of hours that come in parts: every file exactly once.

    lines of the landed files, each with its file                      one scan
      -> per file its digest, and its state by the ledger              aggregation, one row per file
      -> ledger: the files to load are LOADING
      -> lines of those files alone: classes, rejects, stage           the hourly load
      -> publish by (d, h, shard, part), a part per file               dynamic partition overwrite
      -> ledger: they are LOADED

A run that is cut short at any point is run again: its files are met as ``resumed``, their parts are found present with
the same rows or are written, and nothing is doubled or lost.  A file delivered twice, under its own name or another, is
loaded once; a file whose content changed after it was met is refused before anything is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import derive
from ..session import new_scratch_path
from ..sources import ledger, tables
from . import ingest, lifecycle

TO_LOAD = (ledger.NEW, ledger.RESUMED)


def _check_units(spark: SparkSession, main_path: str, hours, ug_from: int, ug_to: int) -> None:
    """No overlapping unit in these hours, and no rows of the unit outside parts."""
    own = tables.shard_label(ug_from, ug_to)
    for hour in hours:
        if ingest.unit_present(spark, main_path, hour, ug_from, ug_to):
            folder = tables.partition_path(main_path, ["d", "h", "shard"], [hour.date(), hour.hour, own])
            if any("/part=" not in f for f in tables.data_files(spark, folder)):
                raise lifecycle.LifecycleError(f"hour {hour} was loaded whole, not in parts")


def load_lines(spark: SparkSession, lines: DataFrame, ug_from: int, ug_to: int, main_path: str,
               ledger_path: str | None = None, cluster_partitions: int | None = None,
               rejects_path: str | None = None) -> dict:
    """Load ``lines(value, file, src_hour)``; returns the files by state and the counts of the load.

    ``lines`` is read twice, for digests and for the load.  The driver holds the paths of this batch's files.
    """
    derive.check_groups(ug_from, ug_to)
    shard, ledger_path = tables.shard_label(ug_from, ug_to), ledger_path or ledger.path_of(main_path)
    seen_path = new_scratch_path(spark, "files")
    try:
        found = ledger.described(lines)
        found.write.parquet(seen_path)
        files = spark.read.schema(found.schema).parquet(seen_path)
        days = [r[0] for r in files.select(ledger.day_label(F.col("src_hour"))).distinct().collect()]
        states = ledger.judged(files, ledger.entries(spark, ledger_path, shard, days))
        rows = states.select("path", "src_hour", "part", "lines", "digest", "state").collect()
        by_state: dict[str, list[str]] = {}
        for r in rows:
            by_state.setdefault(r["state"], []).append(r["path"])
        status = {"files": {k: sorted(v) for k, v in sorted(by_state.items())}}
        if ledger.CHANGED in by_state:
            raise lifecycle.LifecycleError(f"changed since they were met: {sorted(by_state[ledger.CHANGED])}")
        todo = [r for r in rows if r["state"] in TO_LOAD]
        noted = [r for r in rows if r["state"] in (*TO_LOAD, ledger.DUPLICATE)]
        if not noted:
            return {"status": "nothing to load", **status}
        _check_units(spark, main_path, {r["src_hour"] for r in todo if r["src_hour"]}, ug_from, ug_to)
        batch = ledger.batch_label(r["path"] for r in noted)
        kept = spark.createDataFrame(noted, states.select("path", "src_hour", "part", "lines", "digest", "state").schema)
        duplicate = F.col("state") == ledger.DUPLICATE
        ledger.record(kept, ledger_path, shard, batch, F.when(duplicate, F.col("state")).otherwise(ledger.LOADING))
        report = {"status": "nothing to load"}
        if todo:
            wanted = F.broadcast(spark.createDataFrame([(r["path"], r["part"]) for r in todo], "file string, part string"))
            chosen = ingest.flagged_lines(lines.join(wanted, "file"), keep=["part"])
            report = ingest.load_flagged(spark, chosen, ug_from, ug_to, main_path, batch, cluster_partitions,
                                         rejects_path, below=["part"])
        ledger.record(kept, ledger_path, shard, batch, F.when(duplicate, F.col("state")).otherwise(ledger.LOADED))
        return {**report, **status}
    finally:
        tables.delete_path(spark, seen_path)


def load_parts(spark: SparkSession, paths: list[str], ug_from: int, ug_to: int, main_path: str,
               ledger_path: str | None = None, cluster_partitions: int | None = None,
               rejects_path: str | None = None) -> dict:
    """Load landed files (or folders of them) in parts, each file once; the hour comes from a file's path."""
    return load_lines(spark, ledger.read_lines(spark, *paths), ug_from, ug_to, main_path, ledger_path,
                      cluster_partitions, rejects_path)
