"""Hourly ingest: raw events of one hour -> cleaned, derived -> event table.

    read (TSV hour files or any 22-column frame)
      -> class of every row: loaded, rejected, no_key, stray, other_groups
      -> strip, defaults, scheme repair, dom, refhash, d, h    (narrow)
      -> staging table by class (shared scratch folder)        (narrow write, no shuffle)
      -> publish the loaded class by (d, h, shard)             (one shuffle, dynamic overwrite)

Every row is accounted for: the status counts each class, and the rows of ``rejected`` (does not
parse), ``no_key`` (no user or time) and ``stray`` (outside its file's hour) are written as lines to
the reject folder, ``<event table>_rejects`` unless another is named.  ``other_groups`` are rows of
users that another shard loads.

The load unit is an hour and a range of user groups, a partition ``(d, h, shard)`` of the event
table.  A unit that is present is skipped, so reruns change nothing; units of one hour must not overlap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, derive
from ..session import new_scratch_path
from ..sources import tables, tsv
from . import lifecycle

UNIT = ["d", "h", "shard"]
LOADED, REJECTED, NO_KEY, STRAY, OTHER_GROUPS = "loaded", "rejected", "no_key", "stray", "other_groups"
CLASSES = (LOADED, REJECTED, NO_KEY, STRAY, OTHER_GROUPS)
KEPT_AS_LINES = (REJECTED, NO_KEY, STRAY)


def select_hour(raw: DataFrame, hour: dt.datetime, ug_from: int, ug_to: int) -> DataFrame:
    """Rows of one hour and one range of user groups (bounds checked)."""
    return raw.where(derive.in_hour(F.col("sec"), hour)
                     & derive.in_user_groups(F.col("uid"), ug_from, ug_to))


def prepare(raw: DataFrame, keep=()) -> tuple[DataFrame, DataFrame]:
    """(event table rows, rejects): cleaning then stored derived columns."""
    ok, rejects = clean.split_rejects(raw)
    return tables.event_table_frame(clean.clean(ok), keep), rejects


def ingest_hour(raw: DataFrame, hour: dt.datetime, ug_from: int, ug_to: int, keep=()) -> DataFrame:
    """Event table rows of one hour from a raw 22-column frame (no write)."""
    rows, _ = prepare(select_hour(raw, hour, ug_from, ug_to), keep)
    return rows


def row_class(hour: Column, ug_from: int, ug_to: int, bad: Column) -> Column:
    """Which of ``CLASSES`` a row belongs to; the first that holds."""
    sec, uid = F.col("sec"), F.col("uid")
    own = (sec >= hour) & (sec < hour + F.expr("INTERVAL 1 HOUR"))
    return (F.when(bad, F.lit(REJECTED))
            .when(sec.isNull() | uid.isNull(), F.lit(NO_KEY))
            .when(~F.coalesce(own, F.lit(False)), F.lit(STRAY))
            .when(~derive.in_user_groups(uid, ug_from, ug_to), F.lit(OTHER_GROUPS))
            .otherwise(F.lit(LOADED)))


def flagged_lines(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows of text ``lines(value, src_hour)`` with ``_bad``, ``src_hour`` and the ``line`` itself
    (+ ``keep`` columns)."""
    kept = lines.withColumn("line", F.col("value"))
    also = ["src_hour", "line", *keep]
    return tsv.parse_flagged(tsv.split_lines(kept, keep=also), keep=also)


def flagged_frame(raw: DataFrame, hour: dt.datetime) -> DataFrame:
    """A typed 22-column frame in the form of ``flagged_lines``."""
    return raw.withColumns({"_bad": F.lit(False), "src_hour": derive.ntz_literal(hour), "line": tsv.line_of()})


def load_flagged(spark: SparkSession, flagged: DataFrame, ug_from: int, ug_to: int, main_path: str,
                 name: str, cluster_partitions: int | None = None, rejects_path: str | None = None,
                 below: Sequence[str] = ()) -> dict:
    """Stage rows with their class, keep the rejects, publish the rest; returns the status with counts.
    ``below``: columns of ``flagged`` that partition a load unit further."""
    kind = row_class(F.col("src_hour"), ug_from, ug_to, F.col("_bad"))
    rows = flagged.withColumns({"class": kind, "shard": F.lit(tables.shard_label(ug_from, ug_to))})
    rows = tables.event_table_frame(clean.clean(rows), keep=["src_hour", "line", "class", "shard", *below])
    # a line is needed only where it will be kept
    rows = rows.withColumn("line", F.when(F.col("class").isin(*KEPT_AS_LINES), F.col("line")))
    stage = new_scratch_path(spark, f"stage-{name}")
    try:
        rows.write.partitionBy("class").parquet(stage)
        # known schema: an hour without rows writes no file and still reads as empty
        staged = spark.read.schema(rows.schema).parquet(stage)
        counts = {r["class"]: r["n"] for r in staged.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
        status = {"lines": sum(counts.values()), **{c: counts.get(c, 0) for c in CLASSES}}
        if any(status[c] for c in KEPT_AS_LINES):
            status["rejects"] = rejects_path or main_path.rstrip("/") + "_rejects"
            (staged.where(F.col("class").isin(*KEPT_AS_LINES))
             .select("line", F.col("class").alias("reason"), "shard", *below,
                     F.coalesce(F.date_format("src_hour", "yyyy-MM-dd'T'HH"), F.lit("unknown")).alias("hour"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("hour", "shard", *below).parquet(status["rejects"]))
        if not status[LOADED]:
            return {"status": "empty", **status}
        loaded = staged.where(F.col("class") == LOADED).drop("class", "line", "src_hour")
        report = lifecycle.publish(spark, loaded, main_path, [*UNIT, *below], cluster_partitions)
        return {"status": "loaded", **status, "report": report}
    finally:
        tables.delete_path(spark, stage)  # the staging table ends empty


def unit_present(spark: SparkSession, main_path: str, hour: dt.datetime, ug_from: int, ug_to: int) -> bool:
    """Whether the hour holds these user groups (from folders alone); raises if another unit overlaps them."""
    own = tables.shard_label(ug_from, ug_to)
    units = tables.listed_shards(spark, main_path, hour.date(), hour.hour)
    for other in set(units) - {own}:
        lo, hi = (int(x) for x in other[1:].split("_"))
        if lo <= ug_to and ug_from <= hi:
            raise lifecycle.LifecycleError(f"hour {hour} holds user groups {lo}-{hi}, which overlap {ug_from}-{ug_to}")
    return own in units


def load_hour(spark: SparkSession, raw: DataFrame, hour: dt.datetime, ug_from: int, ug_to: int,
              main_path: str, cluster_partitions: int | None = None, rejects_path: str | None = None) -> dict:
    """Load one hour exactly once from a frame, which may hold other hours too: those are not of this
    load.  Returns a small status record.

    ``cluster_partitions``: key ranges of the hour's files (about hour bytes /
    256 MB at scale; default ``spark.sql.shuffle.partitions``).
    """
    derive.check_groups(ug_from, ug_to)
    hour = hour.replace(minute=0, second=0, microsecond=0)
    if unit_present(spark, main_path, hour, ug_from, ug_to):
        return {"hour": hour, "status": "present"}
    own = raw.where(derive.in_hour(F.col("sec"), hour) | F.col("sec").isNull())
    return {"hour": hour, **load_flagged(spark, flagged_frame(own, hour), ug_from, ug_to, main_path,
                                         f"{hour:%Y%m%dT%H}", cluster_partitions, rejects_path)}


def _hour_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of hour files with the hour named in each file's path."""
    return (spark.read.option("lineSep", "\n").text(list(paths))
            .withColumn("src_hour", tsv.hour_key(F.col("_metadata.file_path"))))


def load_hour_file(spark: SparkSession, path: str, ug_from: int, ug_to: int, main_path: str,
                   cluster_partitions: int | None = None, rejects_path: str | None = None) -> dict:
    """Load a tab-separated hour file (or folder of part files) once; the hour comes from its path."""
    derive.check_groups(ug_from, ug_to)
    hour = spark.range(1).select(tsv.hour_key(F.lit(path)).alias("h")).first()["h"]
    if hour is None:
        raise ValueError(f"no hour in path {path!r}")
    if unit_present(spark, main_path, hour, ug_from, ug_to):
        return {"hour": hour, "status": "present"}
    lines = spark.read.option("lineSep", "\n").text(path).withColumn("src_hour", derive.ntz_literal(hour))
    return {"hour": hour, **load_flagged(spark, flagged_lines(lines), ug_from, ug_to, main_path,
                                         f"{hour:%Y%m%dT%H}", cluster_partitions, rejects_path)}


def hour_file(landing_root: str, hour: dt.datetime, shard: str) -> str:
    """Landing layout of an hour file: ``<root>/<yyyy-mm-dd>/<HH>_<shard>.txt``."""
    return f"{landing_root.rstrip('/')}/{hour:%Y-%m-%d}/{hour:%H}_{shard}.txt"


def load_day_files(spark: SparkSession, landing_root: str, day: dt.date, shard: str,
                   ug_from: int, ug_to: int, main_path: str,
                   cluster_partitions: int | None = None, rejects_path: str | None = None) -> list[dict]:
    """Load the 24 hour files of a day for one shard, each hour once.

    Hours run one after the other (each is one Spark job over its file); a
    missing file is reported, not fatal, and a rerun loads only what is left.
    """
    out = []
    for h in range(24):
        hour = dt.datetime.combine(day, dt.time(h))
        path = hour_file(landing_root, hour, shard)
        if not tables.path_exists(spark, path):
            out.append({"hour": hour, "status": "missing"})
            continue
        out.append(load_hour_file(spark, path, ug_from, ug_to, main_path, cluster_partitions, rejects_path))
    return out


def load_day_batched(spark: SparkSession, landing_root: str, day: dt.date, shard: str,
                     ug_from: int, ug_to: int, main_path: str,
                     cluster_partitions: int | None = None, rejects_path: str | None = None) -> dict:
    """Load the not yet loaded hour files of a day in one Spark job.

    Same result as ``load_day_files``, but one read of all pending files: each
    row takes its hour from its own file path (``_metadata.file_path``), then one
    stage and one publish cover every hour at once.  Units already in the table are not read.
    """
    derive.check_groups(ug_from, ug_to)
    hours = [dt.datetime.combine(day, dt.time(h)) for h in range(24)]
    files = {hr: hour_file(landing_root, hr, shard) for hr in hours}
    files = {hr: p for hr, p in files.items() if tables.path_exists(spark, p)}
    present = {hr for hr in files if unit_present(spark, main_path, hr, ug_from, ug_to)}
    todo = [p for hr, p in sorted(files.items()) if hr not in present]
    known = {"day": day, "present": len(present), "missing": 24 - len(files)}
    if not todo:
        return {**known, "status": "nothing to load"}
    return {**known, **load_flagged(spark, flagged_lines(_hour_lines(spark, *todo)), ug_from, ug_to, main_path,
                                    f"{day:%Y%m%d}", cluster_partitions, rejects_path)}
