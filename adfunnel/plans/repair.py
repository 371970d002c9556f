"""Incremental repair of funnels: delta maintenance instead of a rebuild.

When events come late (an hour, a part of one, the first hours of the next day) or go, only the groups
they belong to can change.  The repair

    changed events -> their groups (is_ssp, day, slot, exposure)             one narrow scan
      funnel rows of all other groups                                        anti-join, kept as they are
      events of those groups alone, from the hours their slots span          semi-join, one shuffle
        -> stitched anew
      -> union

so it reads the hours around the late ones and shuffles the changed groups, where a rebuild reads 26 hours and
shuffles all of them.  The result is the rows of a full build, whatever changed.  A group is named by values a
funnel row still holds: the branch by its type, the slot by its anchor's time, as anchors lie in one slot.

The key set is broadcast behind a count (``membership.BROADCAST_MAX_ROWS``); beyond it both joins shuffle
on the group key, and the aggregation after the semi-join uses that partitioning again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.derive import date_literal
from ..operators import funnel as fn
from ..operators import membership, slots
from ..session import new_scratch_path
from ..sources import tables
from . import lifecycle

KEY = fn.GROUP_KEY


def changed_groups(changed: DataFrame, ssp_sites: DataFrame, days: Sequence | None = None) -> DataFrame:
    """Groups that the changed events (come or gone) belong to, each once."""
    return fn.slot_rows(changed, ssp_sites, days).select(*KEY).distinct()


def with_group(funnel_rows: DataFrame) -> DataFrame:
    """Funnel rows with the group that each stands for (``KEY``; ``expid`` is a column of its own)."""
    marked = funnel_rows.withColumns({"is_ssp": F.col("tn") == schema.TN_BID, "role": F.lit(slots.ANCHOR)})
    return slots.assign_slots(marked).drop("role")


def repaired(old: DataFrame, events: DataFrame, groups: DataFrame, ssp_sites: DataFrame,
             tiebreak: Sequence[str] = (), days: Sequence | None = None) -> DataFrame:
    """The funnel of ``events`` (all that are there now), given ``old``, the funnel before the change, and the
    ``groups`` that changed."""
    keys = F.broadcast(groups) if membership.fits_broadcast(groups) else groups
    kept = with_group(old).join(keys, KEY, "left_anti").select(*schema.FUNNEL_COLUMNS)
    again = fn.slot_rows(events, ssp_sites, days).join(keys, KEY, "left_semi")
    return kept.unionByName(fn.stitch(again, tiebreak).select(*schema.FUNNEL_COLUMNS))


def hours_read(slot_keys: Iterable[tuple[bool, dt.date, int]]) -> list[tuple[dt.date, int]]:
    """The ``(d, h)`` partitions that hold the events of these (is_ssp, slot_d, slot)."""
    return sorted({(day + dt.timedelta(days=ahead), h) for is_ssp, day, slot in slot_keys
                   for ahead, h in slots.hours_of(is_ssp, slot)})


def repair_day(spark: SparkSession, events_path: str, changed: DataFrame, ssp_sites: DataFrame, day: dt.date,
               funnel_path: str, tiebreak: Sequence[str] = ()) -> dict:
    """Repair funnel partition ``day`` after ``changed`` events came or went; returns what was done.

    ``changed`` holds the rows that came, and those that went if hours were replaced.  The partition must have been
    built.  Its new rows are staged before they replace it, as they read the partition they replace; a partition
    left without rows is removed.  A run that is cut short leaves the old partition or the new one, and the
    repair can be run again.
    """
    folder = tables.partition_path(funnel_path, ["d"], [day])
    if not tables.data_files(spark, folder):
        raise lifecycle.LifecycleError(f"funnel of {day} is not built")
    key_path, stage = (new_scratch_path(spark, f"repair-{x}-{day:%Y%m%d}") for x in ("keys", "rows"))
    try:
        found = changed_groups(changed, ssp_sites, [day])
        found.write.parquet(key_path)
        groups = spark.read.schema(found.schema).parquet(key_path)
        # a day has at most 13 slots
        slot_keys = [tuple(r) for r in groups.select("is_ssp", "slot_d", "slot").distinct().collect()]
        if not slot_keys:
            return {"day": day, "groups": 0, "hours": 0}
        hours = hours_read(slot_keys)
        old = spark.read.schema(schema.FUNNEL_SCHEMA).parquet(funnel_path).where(F.col("d") == date_literal(day))
        events = tables.read_partitions(spark, events_path, ["d", "h"], hours)
        if events is None:  # all of them went
            events = changed.limit(0)
        rows = repaired(old, events, groups, ssp_sites, tiebreak, [day])
        rows.write.parquet(stage)
        staged = spark.read.schema(rows.schema).parquet(stage)
        n = staged.count()
        if n:
            tables.write_funnel(staged, funnel_path)
        else:
            lifecycle.drop_day_partitions(spark, funnel_path, [day])
        spark.catalog.refreshByPath(funnel_path)
        return {"day": day, "groups": groups.count(), "hours": len(hours), "rows": n}
    finally:
        tables.delete_path(spark, key_path)
        tables.delete_path(spark, stage)


def newer_hours(spark: SparkSession, events_path: str, funnel_path: str, day: dt.date) -> list[tuple[dt.date, int]]:
    """Hours the build of ``day`` reads that hold files newer than it; from folder listings alone."""
    built = tables.data_files(spark, tables.partition_path(funnel_path, ["d"], [day]))
    if not built:
        return []
    wanted = hours_read((is_ssp, day, s) for is_ssp in (False, True) for s in range(len(slots.slot_table(is_ssp))))
    return [(d, h) for d, h in wanted
            if any(t > min(built.values())
                   for t in tables.data_files(spark, tables.partition_path(events_path, ["d", "h"], [d, h])).values())]


def repair_late(spark: SparkSession, events_path: str, ssp_sites: DataFrame, day: dt.date, funnel_path: str,
                tiebreak: Sequence[str] = ()) -> dict:
    """Repair ``day`` from the hours loaded since it was built.

    For hours that were added (loads never replace rows unless asked to).  After a publish with ``replace``
    rows may have gone that no file names any more: give them to ``repair_day``, or build the day anew.
    """
    hours = newer_hours(spark, events_path, funnel_path, day)
    changed = tables.read_partitions(spark, events_path, ["d", "h"], hours) if hours else None
    if changed is None:
        return {"day": day, "groups": 0, "hours": 0}
    return repair_day(spark, events_path, changed, ssp_sites, day, funnel_path, tiebreak)
