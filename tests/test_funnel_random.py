"""Randomised funnel check: events clustered on slot boundaries, brute force as oracle."""

import datetime as dt
import random

from adfunnel import schema
from adfunnel.operators import funnel as fn
from adfunnel.operators import slots

from . import brute
from .helpers import event, frame, ssp_frame


def boundary_seconds():
    marks = set()
    for is_ssp in (False, True):
        for row in slots.slot_table(is_ssp):
            for v in row:
                marks.add(v % slots.DAY)
                marks.add((v + 1) % slots.DAY)
    return sorted(marks)


def random_rows(seed: int, n: int = 600):
    rng = random.Random(seed)
    marks = boundary_seconds()
    base = dt.datetime(2024, 5, 1)
    rows = []
    for i in range(n):
        day = rng.randrange(3)
        if rng.random() < 0.7:
            sod = (rng.choice(marks) + rng.choice((-1, 0, 0, 1))) % slots.DAY
        else:
            sod = rng.randrange(slots.DAY)
        sec = base + dt.timedelta(days=day, seconds=sod)
        expid = rng.randrange(1, 60) if rng.random() > 0.03 else 0
        sid = 900 if expid % 3 == 0 else 5        # one site per exposure
        tn = rng.choice((0, 0, 1, 1, 3, 3, 2))
        sn = 0 if rng.random() > 0.05 else 1
        rows.append(event(i, sec, expid, tn, sid, sn=sn, uid=rng.randrange(5), ipint=rng.randrange(1, 2**32)))
    # exact time ties inside one exposure
    for j in range(20):
        r = dict(rows[rng.randrange(n)])
        r["event_id"] = n + j
        r["uid"] = 99
        rows.append(r)
    return rows


def test_random_funnels_match_brute_force(spark):
    for seed in (1, 2, 3):
        rows = random_rows(seed)
        got = fn.funnel(frame(spark, rows), ssp_frame(spark, [900]), tiebreak=["event_id"]).collect()
        got = sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in got), key=repr)
        assert got == sorted(brute.funnel(rows, {900}), key=repr), seed
        assert len(got) > 50
