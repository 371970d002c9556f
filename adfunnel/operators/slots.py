"""Time slots of the daily funnel build and the assignment of events to them.

A day is cut into slots.  An anchor event (impression for ordinary sites, bid
for SSP sites) belongs to the slot whose anchor window holds it; the windows
tile the day, so every anchor has exactly one slot.  Followers (clicks, and
SSP impressions) may arrive later, up to the follower window end of the slot,
which for the last slots reaches into the next day; a follower can therefore
be offered to two slots (at most two, checked below at import).

Instead of a range join against the slot table (which Spark plans as a nested
loop join), each event computes its one or two slots with a constant CASE
expression on its second of day and is exploded into at most two rows.  The
step is narrow: no shuffle, no join, whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slot tables of the daily build.  Bounds are inclusive, in
# HH:MM:SS from the start of the processed day; hours of 24 and more lie in the
# next day ("25:59:59" is 01:59:59 of the next day).
NONSSP_SLOTS = [
    # begin,      impression end, click end
    ("00:00:00", "05:59:59", "07:59:59"),
    ("06:00:00", "09:59:59", "11:59:59"),
    ("10:00:00", "13:59:59", "15:59:59"),
    ("14:00:00", "16:59:59", "18:59:59"),
    ("17:00:00", "19:59:59", "21:59:59"),
    ("20:00:00", "21:59:59", "23:59:59"),
    ("22:00:00", "23:59:59", "25:59:59"),
]
SSP_SLOTS = [
    # begin,      bid end,    impression end, click end
    ("00:00:00", "05:59:59", "06:01:59", "07:59:59"),
    ("06:00:00", "11:59:59", "12:01:59", "13:59:59"),
    ("12:00:00", "14:59:59", "15:01:59", "16:59:59"),
    ("15:00:00", "17:59:59", "18:01:59", "19:59:59"),
    ("18:00:00", "20:59:59", "21:01:59", "22:59:59"),
    ("21:00:00", "23:59:59", "24:01:59", "25:59:59"),
]

DAY = 86400

# Roles of an event inside a funnel group.
ANCHOR = 0      # impression (ordinary site) or bid (SSP site)
EXPOSURE = 1    # impression following an SSP bid
CLICK = 2

# (is_ssp, role) -> index of the window end column in the slot table row.
_END_COLUMN = {
    (False, ANCHOR): 1,
    (False, CLICK): 2,
    (True, ANCHOR): 1,
    (True, EXPOSURE): 2,
    (True, CLICK): 3,
}


def _seconds(hms: str) -> int:
    h, m, s = (int(x) for x in hms.split(":"))
    return h * 3600 + m * 60 + s


def slot_table(is_ssp: bool) -> list[tuple[int, ...]]:
    """Slots as seconds from the start of the day: (begin, end...) per slot."""
    return [tuple(_seconds(x) for x in row) for row in (SSP_SLOTS if is_ssp else NONSSP_SLOTS)]


def windows(is_ssp: bool, role: int) -> list[tuple[int, int, int, int]]:
    """Windows seen from the event's own day: (days back, slot, lo, hi), hi inclusive.

    ``days back`` is 0 for a slot of the event's day and 1 for a slot of the
    previous day whose window runs past midnight.
    """
    end_col = _END_COLUMN[(is_ssp, role)]
    out = []
    for back in (0, 1):
        for slot, row in enumerate(slot_table(is_ssp)):
            lo = max(row[0] - back * DAY, 0)
            hi = min(row[end_col] - back * DAY, DAY - 1)
            if lo <= hi:
                out.append((back, slot, lo, hi))
    return out


def _check_tables() -> None:
    for is_ssp in (False, True):
        anchor = windows(is_ssp, ANCHOR)
        for (is_s, role), _ in _END_COLUMN.items():
            if is_s != is_ssp:
                continue
            ws = windows(is_ssp, role)
            cuts = sorted({0, DAY} | {w[2] for w in ws} | {w[3] + 1 for w in ws})
            for t in cuts[:-1]:
                hits = sum(1 for w in ws if w[2] <= t <= w[3])
                if hits > 2:
                    raise ValueError(f"slot table gives {hits} windows at second {t}")
        # anchors: exactly one slot of the same day for every second of the day
        covered = sorted((w[2], w[3]) for w in anchor)
        if any(w[0] != 0 for w in anchor) or covered[0][0] != 0 or covered[-1][1] != DAY - 1 or any(
                a[1] + 1 != b[0] for a, b in zip(covered, covered[1:])):
            raise ValueError("anchor windows must tile the day")


_check_tables()


def hours_of(is_ssp: bool, slot: int) -> list[tuple[int, int]]:
    """(days ahead, hour) of every hour in which an event of this slot may lie."""
    row = slot_table(is_ssp)[slot]
    return [divmod(h, 24) for h in range(row[0] // 3600, max(row[1:]) // 3600 + 1)]


#: Hours of the next day in which followers may lie.
LOOKAHEAD_HOURS = 1 + max(h for is_ssp in (False, True) for s in range(len(slot_table(is_ssp)))
                          for ahead, h in hours_of(is_ssp, s) if ahead)


_CODE_BASE = 8  # slot code = days back * 8 + slot


def _pick(ws: list[tuple[int, int, int, int]], tod: str) -> str:
    """SQL CASE over windows in the given order -> int code of the first hit (NULL if none)."""
    arms = " ".join(f"WHEN {tod} BETWEEN {lo} AND {hi} THEN {back * _CODE_BASE + slot}"
                    for back, slot, lo, hi in ws)
    return f"CASE {arms} END"


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def slot_codes_sql(tod: str, is_ssp: str, role: str) -> str:
    """SQL for the array of the one or two slot codes of an event ([NULL] if none).

    ``tod`` is the second of the day.  At most two windows hold any second
    (checked at import), so the first and the last hit in window order name
    them all.  Built as one SQL expression (parsed once by the JVM).
    """
    first, last = [], []
    for (ssp, r) in _END_COLUMN:
        ws = windows(ssp, r)
        cond = f"{is_ssp} = {str(ssp).lower()} AND {role} = {r}"
        first.append(f"WHEN {cond} THEN {_pick(ws, tod)}")
        last.append(f"WHEN {cond} THEN {_pick(list(reversed(ws)), tod)}")
    return f"array_distinct(array(CASE {' '.join(first)} END, CASE {' '.join(last)} END))"


def assign_slots(df: DataFrame, ts_col: str = "sec", ssp_col: str = "is_ssp",
                 role_col: str = "role") -> DataFrame:
    """Add ``slot_d`` (the processed day) and ``slot``; one or two rows per event.

    Rows need a timestamp_ntz ``ts_col``, a boolean ``ssp_col`` and an integer
    ``role_col`` (ANCHOR / EXPOSURE / CLICK); rows outside every window go.
    """
    with_tod = df.withColumn("_tod", second_of_day(F.col(ts_col)))
    codes = F.expr(slot_codes_sql("_tod", f"`{ssp_col}`", f"`{role_col}`"))
    exploded = with_tod.withColumn("_code", F.explode(codes))
    day = F.to_date(F.col(ts_col))
    return (exploded.where(F.col("_code").isNotNull())
            .withColumn("slot_d", F.date_sub(day, F.shiftright(F.col("_code"), 3)))
            .withColumn("slot", F.col("_code").bitwiseAND(_CODE_BASE - 1))
            .drop("_code", "_tod"))
