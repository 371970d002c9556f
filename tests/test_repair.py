"""A repaired funnel holds the rows of a full build, whatever came or went."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adfunnel import schema
from adfunnel.operators import funnel as fn
from adfunnel.operators import slots
from adfunnel.plans import daily, lifecycle, repair
from adfunnel.session import new_scratch_path
from adfunnel.sources import tables

from .helpers import frame, plan_text, ssp_frame
from .test_funnel_random import random_rows

TB = ["event_id"]


def _rows(df):
    return sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_repair_equals_full_build(spark, seed):
    rows = random_rows(seed)
    ssp = ssp_frame(spark, [900])
    rng = random.Random(seed)
    came = [r for r in rows if r["sec"].hour in (1, 13) or rng.random() < 0.1]
    gone = [dict(r, event_id=r["event_id"] + 10_000) for r in rng.sample(rows, 40)]  # were there before, are no more
    before = [r for r in rows if r not in came] + gone
    old = fn.funnel(frame(spark, before), ssp, TB)
    groups = repair.changed_groups(frame(spark, came + gone), ssp)
    got = repair.repaired(old, frame(spark, rows), groups, ssp, TB)
    want = fn.funnel(frame(spark, rows), ssp, TB)
    assert _rows(got) == _rows(want) != _rows(old)
    # nothing changed: nothing is stitched, all is kept
    assert _rows(repair.repaired(want, frame(spark, rows), groups.limit(0), ssp, TB)) == _rows(want)


def test_groups_of_funnel_rows_are_those_they_were_built_from(spark):
    rows = frame(spark, random_rows(6))
    ssp = ssp_frame(spark, [900])
    anchors = (fn.slot_rows(rows, ssp).where(F.col("role") == slots.ANCHOR).select(*repair.KEY).distinct())
    named = repair.with_group(fn.funnel(rows, ssp, TB)).select(*repair.KEY)
    assert sorted(map(tuple, anchors.collect())) == sorted(map(tuple, named.collect()))


def test_hours_of_a_slot_hold_all_its_events():
    for is_ssp in (False, True):
        for slot in range(len(slots.slot_table(is_ssp))):
            hours = set(slots.hours_of(is_ssp, slot))
            for role in (slots.ANCHOR, slots.CLICK, *((slots.EXPOSURE,) if is_ssp else ())):
                for back, s, lo, hi in slots.windows(is_ssp, role):
                    if s == slot:
                        assert {(back, t // 3600) for t in (lo, hi)} <= hours
    assert repair.hours_read([(False, dt.date(2024, 1, 2), 6)]) == [
        (dt.date(2024, 1, 2), 22), (dt.date(2024, 1, 2), 23), (dt.date(2024, 1, 3), 0), (dt.date(2024, 1, 3), 1)]


def test_repair_day_on_tables(spark):
    """Built without two hours, which come later: only the hours around them are read again."""
    rows = random_rows(7)
    ssp = ssp_frame(spark, [900])
    day = dt.date(2024, 5, 2)
    late = {(dt.date(2024, 5, 2), 10), (dt.date(2024, 5, 3), 1)}
    is_late = lambda r: (r["sec"].date(), r["sec"].hour) in late
    events, out, full = (new_scratch_path(spark, x) for x in ("events", "funnel", "full"))

    def load(some):
        ev = tables.event_table_frame(frame(spark, some), keep=TB)
        tables.write_partitioned(ev, events, ["d", "h"], tables.EVENT_SORT, 4)

    load([r for r in rows if not is_late(r)])
    daily.build_day(spark, events, ssp, day, out, require_complete=False, tiebreak=TB)
    assert repair.repair_late(spark, events, ssp, day, out, TB) == {"day": day, "groups": 0, "hours": 0}
    load([r for r in rows if is_late(r)])
    assert set(repair.newer_hours(spark, events, out, day)) == late
    done = repair.repair_late(spark, events, ssp, day, out, TB)
    daily.build_day(spark, events, ssp, day, full, require_complete=False, tiebreak=TB)
    assert done["groups"] > 0 and done["hours"] < 26
    assert _rows(spark.read.parquet(out)) == _rows(spark.read.parquet(full))
    assert repair.repair_late(spark, events, ssp, day, out, TB)["groups"] == 0  # up to date now
    # all events of the day go: the partition goes too
    all_rows = spark.read.parquet(events)
    gone = all_rows.where(f"d = date'{day}'").toPandas()
    lifecycle.drop_day_partitions(spark, events, [day])
    lifecycle.drop_day_partitions(spark, events, [day + dt.timedelta(days=1)])
    spark.catalog.refreshByPath(events)
    assert len(gone)
    repair.repair_day(spark, events, frame(spark, rows), ssp, day, out, TB)
    assert not tables.data_files(spark, tables.partition_path(out, ["d"], [day]))
    with pytest.raises(lifecycle.LifecycleError, match="not built"):
        repair.repair_day(spark, events, frame(spark, rows), ssp, day, out, TB)


def test_repair_shuffles_no_unchanged_group(spark):
    rows = frame(spark, random_rows(8))
    ssp = ssp_frame(spark, [900])
    groups = repair.changed_groups(rows.where("event_id < 10"), ssp)
    text = plan_text(repair.repaired(fn.funnel(rows, ssp, TB), rows, groups, ssp, TB))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "LeftSemi" in text and "SortMergeJoin" not in text
