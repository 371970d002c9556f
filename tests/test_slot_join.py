"""Slots as a table: the same rows as the literal form, and any table against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest

from adfunnel import schema
from adfunnel.operators import funnel as fn
from adfunnel.operators import slot_join, slots

from .helpers import frame, plan_text, ssp_frame
from .test_funnel_random import random_rows


def _pairs(df):
    return Counter((r["event_id"], r["slot_d"], r["slot"]) for r in df.select("event_id", "slot_d", "slot").collect())


@pytest.mark.parametrize("bin_seconds", [60, 900, 86400])
def test_standard_slots_as_a_table(spark, bin_seconds):
    rows = fn.branch_rows(frame(spark, random_rows(21)), ssp_frame(spark, [900]))
    want = _pairs(slots.assign_slots(rows))
    assert _pairs(slot_join.assign_slots(rows, slot_join.standard_slots(spark), bin_seconds)) == want and len(want) > 100


def test_any_table_against_brute_force(spark):
    rng = random.Random(9)
    table = []
    for slot in range(60):
        lo = rng.choice([0, 3599, 3600, 86399, 86400, rng.randrange(200000)])
        hi = lo + rng.choice([-1, 0, 1, 3600, 100000, 250000])  # empty, a second, over several days
        table.append((rng.random() < 0.5, rng.randrange(3), slot, lo, hi))
    events = []
    for i in range(200):
        sod = rng.choice([0, 1, 3599, 3600, 86399, rng.randrange(86400)])
        events.append((i, dt.datetime(2024, 5, 1) + dt.timedelta(days=rng.randrange(3), seconds=sod), rng.random() < 0.5, rng.randrange(3)))
    df = spark.createDataFrame(events, "event_id bigint, sec timestamp_ntz, is_ssp boolean, role int")
    want = Counter()
    for i, sec, is_ssp, role in events:
        for s, r, slot, lo, hi in table:
            for back in range(6):
                day = sec.date() - dt.timedelta(days=back)
                t = int((sec - dt.datetime.combine(day, dt.time())).total_seconds())
                if (s, r) == (is_ssp, role) and lo <= t <= hi:
                    want[(i, day, slot)] += 1
    got = slot_join.assign_slots(df, spark.createDataFrame(table, slot_join.SCHEMA), 1800)
    assert _pairs(got) == want and want
    assert slot_join.assign_slots(df, spark.createDataFrame([], slot_join.SCHEMA)).count() == 0


def test_the_join_is_an_equi_join_and_feeds_the_funnel(spark, monkeypatch):
    rows, ssp = frame(spark, random_rows(22)), ssp_frame(spark, [900])
    table = slot_join.standard_slots(spark)
    by_table = fn.funnel(rows, ssp, ["event_id"], slot_table=table)
    assert "NestedLoop" not in plan_text(by_table) and "Cartesian" not in plan_text(by_table)
    as_set = lambda df: {tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in df.collect()}
    assert as_set(by_table) == as_set(fn.funnel(rows, ssp, ["event_id"]))
    # beyond the broadcast bound the planner chooses; the key is still an equi-key
    monkeypatch.setattr(slot_join.membership, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = slot_join.assign_slots(fn.branch_rows(rows, ssp).drop("ref"), table)
        assert "SortMergeJoin" in plan_text(wide) or "ShuffledHashJoin" in plan_text(wide)
        assert _pairs(wide) == _pairs(slots.assign_slots(fn.branch_rows(rows, ssp)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
