"""Daily funnel build and the backfill loop.

A day D is built from the event partitions of D and D+1 (followers of the
last slots arrive until 01:59:59 of D+1).  The build is gated on D holding all
24 hours.  Its rows all fall in funnel partition D (anchors tile the day), so
the result replaces exactly that partition: a rerun, e.g. after the first
hours of D+1 arrived, is safe.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import date_literal
from ..operators import funnel as fn
from ..operators import slots
from ..sources import tables
from . import lifecycle, repair


class IncompleteDay(RuntimeError):
    pass


LOOKAHEAD_HOURS = slots.LOOKAHEAD_HOURS  # followers of the last slots arrive until 01:59:59 of D+1


def day_scope(events: DataFrame, day: dt.date) -> DataFrame:
    """Day D and the first two hours of D+1, as partition filters when possible.

    On the (d, h) event table this reads 26 hour partitions, not 48.
    """
    nxt = day + dt.timedelta(days=1)
    if "d" in events.columns and "h" in events.columns:
        return events.where((F.col("d") == date_literal(day))
                            | ((F.col("d") == date_literal(nxt)) & (F.col("h") < LOOKAHEAD_HOURS)))
    d = F.col("d") if "d" in events.columns else F.to_date("sec")
    return events.where(d.isin(date_literal(day), date_literal(nxt))
                        & (F.col("sec") < F.expr(f"TIMESTAMP_NTZ '{nxt:%Y-%m-%d} 0{LOOKAHEAD_HOURS}:00:00'")))


def funnel_for_day(events: DataFrame, ssp_sites: DataFrame, day: dt.date,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    return fn.funnel(day_scope(events, day), ssp_sites, tiebreak, days=[day])


def lookahead_ready(spark: SparkSession, events_path: str, day: dt.date) -> bool:
    """Hours 0 and 1 of D+1 are loaded (late clicks of D are in)."""
    loaded = tables.listed_hours(spark, events_path, day + dt.timedelta(days=1))
    return set(range(LOOKAHEAD_HOURS)) <= set(loaded)


def build_day(spark: SparkSession, events_path: str, ssp_sites: DataFrame, day: dt.date,
              out_path: str, require_complete: bool = True, require_lookahead: bool = False,
              tiebreak: Sequence[str] = ()) -> None:
    """Build and write funnel partition ``day``.

    Gate: the day holds 24 hours (as the original build); with
    ``require_lookahead`` also the first two hours of the next day, so no late
    click is missed.  Without it, rebuild the day once they have arrived.
    A build without rows leaves no partition.
    """
    if require_complete and not lifecycle.path_is_complete(spark, events_path, day):
        raise IncompleteDay(f"day {day} does not hold 24 hours")
    if require_lookahead and not lookahead_ready(spark, events_path, day):
        raise IncompleteDay(f"hours 0-1 of the day after {day} are not loaded")
    events = spark.read.parquet(events_path)
    folder = tables.partition_path(out_path, ["d"], [day])
    before = tables.data_files(spark, folder)
    tables.write_funnel(funnel_for_day(events, ssp_sites, day, tiebreak), out_path)
    # dynamic overwrite leaves a partition alone when no row goes there
    if before and tables.data_files(spark, folder).keys() == before.keys():
        lifecycle.drop_day_partitions(spark, out_path, [day])
        spark.catalog.refreshByPath(out_path)


def build_reason(spark: SparkSession, events_path: str, funnel_path: str, day: dt.date) -> str | None:
    """Why ``day`` has to be built: ``built`` (it is not there) or ``rebuilt`` (an hour it reads is
    newer than it); None if it is up to date.  From folder listings alone."""
    built = tables.data_files(spark, tables.partition_path(funnel_path, ["d"], [day]))
    if not built:
        return "built"
    nxt = day + dt.timedelta(days=1)
    inputs = [tables.partition_path(events_path, ["d"], [day])]
    inputs += [tables.partition_path(events_path, ["d", "h"], [nxt, h]) for h in range(LOOKAHEAD_HOURS)]
    newest = max((t for p in inputs for t in tables.data_files(spark, p).values()), default=0)
    return "rebuilt" if newest > min(built.values()) else None


def backfill(spark: SparkSession, today: dt.date, load_day, events_path: str, funnel_path: str,
             ssp_sites: DataFrame, days: int = 13, rebuild_late: bool = True,
             repair_late: bool = False) -> list[tuple[dt.date, str]]:
    """For each of the ``days`` days before ``today``: ingest then build.

    ``load_day(day)`` loads the 24 hours of a day (e.g. ``ingest.load_day_batched``).
    Each stage runs only while its table holds fewer days than the fill cap.
    Days run in ascending order, one at a time; inside each, Spark runs the
    work in parallel.  A day that is built and newer than the hours it reads is skipped.
    With ``rebuild_late`` a day is built again once hours it reads have come later (the first
    two of the next day carry its late clicks); its rows all sit in its own partition, so this is safe.
    With ``repair_late`` such a day is repaired from the late hours instead (``repair.repair_late``: for
    hours that were added, not replaced) and reported as ``repaired``.
    """
    done = []

    def build(day: dt.date) -> None:
        reason = build_reason(spark, events_path, funnel_path, day)
        if reason is None or (reason == "rebuilt" and not rebuild_late):
            return
        if reason == "built" and not lifecycle.path_needs_fill(spark, funnel_path):
            return
        if reason == "rebuilt" and repair_late:
            repair.repair_late(spark, events_path, ssp_sites, day, funnel_path)
            done.append((day, "repaired"))
            return
        try:
            build_day(spark, events_path, ssp_sites, day, funnel_path)
            done.append((day, reason))
        except IncompleteDay:
            done.append((day, "incomplete"))

    for i in range(days, 0, -1):
        day = today - dt.timedelta(days=i)
        if lifecycle.path_needs_fill(spark, events_path):
            load_day(day)
        if i < days and tables.data_files(spark, tables.partition_path(
                funnel_path, ["d"], [day - dt.timedelta(days=1)])):
            build(day - dt.timedelta(days=1))
        build(day)
    return done
