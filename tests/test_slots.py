"""Slot assignment against a plain scan of the slot windows, at every boundary."""

import datetime as dt

from pyspark.sql import functions as F

from adfunnel.operators import slots


def expected(ts: dt.datetime, is_ssp: bool, role: int) -> set[tuple[dt.date, int]]:
    """Slots whose window (of the event's day or the day before) holds ``ts``."""
    end_col = slots._END_COLUMN[(is_ssp, role)]
    out = set()
    for back in (0, 1):
        day = ts.date() - dt.timedelta(days=back)
        start = dt.datetime.combine(day, dt.time())
        for slot, row in enumerate(slots.slot_table(is_ssp)):
            lo = start + dt.timedelta(seconds=row[0])
            hi = start + dt.timedelta(seconds=row[end_col])
            if lo <= ts <= hi:
                out.add((day, slot))
    return out


def test_assignment_at_every_boundary(spark):
    marks = set()
    for is_ssp in (False, True):
        for row in slots.slot_table(is_ssp):
            for v in row:
                for d in (-1, 0, 1):
                    marks.add((v + d) % slots.DAY)
    base = dt.datetime(2024, 2, 28)  # crosses the month end and a leap day
    rows = []
    for (is_ssp, role) in slots._END_COLUMN:
        for day in range(3):
            for s in sorted(marks):
                rows.append((base + dt.timedelta(days=day, seconds=s), is_ssp, role))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, sec timestamp_ntz, is_ssp boolean, role int")
    got = {}
    for r in slots.assign_slots(df).select("id", "slot_d", "slot").collect():
        got.setdefault(r["id"], set()).add((r["slot_d"], r["slot"]))
    for i, (ts, is_ssp, role) in enumerate(rows):
        assert got.get(i, set()) == expected(ts, is_ssp, role), (ts, is_ssp, role)
    assert max(len(v) for v in got.values()) == 2
