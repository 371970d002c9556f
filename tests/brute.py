"""Brute-force funnel in plain Python, written from the per-slot statements:

for every processed day and slot, per branch, take the rows of each type whose
time lies in that type's window, group them by exposure, keep groups with an
anchor, and read the first row of each type (first = earliest time, then
smallest event id).  Quadratic and single-threaded: for small fixtures only.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

# slots as stated by the original statements, apart from the library's tables: hours of begin, end of anchors, end of clicks
NONSSP = [(0, 6, 8), (6, 10, 12), (10, 14, 16), (14, 17, 19), (17, 20, 22), (20, 22, 24), (22, 24, 26)]
SSP = [(0, 6, 8), (6, 12, 14), (12, 15, 17), (15, 18, 20), (18, 21, 23), (21, 24, 26)]


def slot_table(is_ssp: bool) -> list[tuple]:
    if is_ssp:  # impressions end two minutes after the bids
        return [(b * 3600, e * 3600 - 1, e * 3600 + 119, c * 3600 - 1) for b, e, c in SSP]
    return [(b * 3600, e * 3600 - 1, c * 3600 - 1) for b, e, c in NONSSP]


def funnel(rows: list[dict], ssp_sids: set[int]) -> list[tuple]:
    valid = [r for r in rows if r["sn"] == 0 and r["expid"] != 0 and r["tn"] in (0, 1, 3)]
    days = sorted({r["sec"].date() for r in valid})
    out = []
    for day in days:
        base = dt.datetime.combine(day, dt.time())
        for is_ssp in (False, True):
            branch = [r for r in valid if (r["sid"] in ssp_sids) == is_ssp]
            for slot, row in enumerate(slot_table(is_ssp)):
                def within(r, end_s):
                    return base + dt.timedelta(seconds=row[0]) <= r["sec"] <= base + dt.timedelta(seconds=end_s)
                if is_ssp:
                    picks = {3: row[1], 0: row[2], 1: row[3]}
                else:
                    picks = {0: row[1], 1: row[2]}
                groups = defaultdict(lambda: defaultdict(list))
                for r in branch:
                    if r["tn"] in picks and within(r, picks[r["tn"]]):
                        groups[r["expid"]][r["tn"]].append(r)
                for expid, by_tn in groups.items():
                    first = {tn: min(rs, key=lambda r: (r["sec"], r["event_id"])) for tn, rs in by_tn.items()}
                    anchor_tn = 3 if is_ssp else 0
                    if anchor_tn not in first:
                        continue
                    a = first[anchor_tn]
                    imp = first.get(0)
                    cl = first.get(1)
                    secs = lambda x, y: int((y["sec"] - x["sec"]).total_seconds())
                    delta30 = secs(a, imp) if is_ssp and imp else 0
                    delta01 = secs(imp, cl) if imp and cl else 0
                    out.append((
                        a["uid"], expid, anchor_tn, a["sec"], delta30, delta01, a["ref"], a["sid"], a["sz"],
                        a["bref"], a["geo"], a["ipint"] if is_ssp else 0,
                        (imp["ipint"] if imp else 0), (cl["ipint"] if cl else 0), a["bt"], day,
                    ))
    return out
