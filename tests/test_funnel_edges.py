"""Funnel boundaries on hand-made rows, checked by hand and by brute force."""

import datetime as dt

import pytest

from adfunnel import schema
from adfunnel.operators import funnel as fn
from adfunnel.operators import slots

from . import brute
from .helpers import event, frame, ssp_frame, ts

SSP = 900


def run(spark, rows, ssp=(SSP,)):
    got = fn.funnel(frame(spark, rows), ssp_frame(spark, ssp), tiebreak=["event_id"]).collect()
    return sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in got), key=repr)


def brute_rows(rows, ssp=(SSP,)):
    return sorted(brute.funnel(rows, set(ssp)), key=repr)


def by_expid(result):
    return {(r[1], r[3]): r for r in result}


EDGE_ROWS = [
    # anchors on both sides of the 06:00 slot boundary, one exposure each
    event(1, "2024-03-01 05:59:59", 10, 0, 5),
    event(2, "2024-03-01 06:00:00", 11, 0, 5),
    # a click in two slots (07:00 is in slot 0 and slot 1 click windows), anchors in both
    event(3, "2024-03-01 05:00:00", 12, 0, 5),
    event(4, "2024-03-01 06:30:00", 12, 0, 5),
    event(5, "2024-03-01 07:00:00", 12, 1, 5),
    # click before the impression inside the slot: negative delta01
    event(6, "2024-03-01 10:10:00", 13, 1, 5),
    event(7, "2024-03-01 10:20:00", 13, 0, 5),
    # two impressions in one slot: the earliest is the anchor
    event(8, "2024-03-01 11:00:00", 14, 0, 5),
    event(9, "2024-03-01 10:30:00", 14, 0, 5),
    event(10, "2024-03-01 12:00:00", 14, 1, 5),
    # SSP: click without impression -> delta01 0 but ipint_cl set
    event(11, "2024-03-01 01:00:00", 20, 3, SSP),
    event(12, "2024-03-01 01:30:00", 20, 1, SSP),
    # SSP: bid at 23:59:59, impression at 00:01:59 next day (inside), another at 00:02:00 (outside)
    event(13, "2024-03-01 23:59:59", 21, 3, SSP),
    event(14, "2024-03-02 00:02:00", 21, 0, SSP),
    event(15, "2024-03-02 00:01:59", 21, 0, SSP),
    event(16, "2024-03-02 01:59:59", 21, 1, SSP),
    # invalid rows: expid 0, status 1, type 2 (never used)
    event(17, "2024-03-01 09:00:00", 0, 0, 5),
    event(18, "2024-03-01 09:00:00", 30, 0, 5, sn=1),
    event(19, "2024-03-01 09:00:00", 31, 2, 5),
    # non-SSP late click after midnight belongs to slot 6 of the previous day
    event(20, "2024-03-01 22:30:00", 40, 0, 5),
    event(21, "2024-03-02 01:59:59", 40, 1, 5),
    event(22, "2024-03-02 02:00:00", 40, 1, 5),
    # tie on time: smaller event id wins
    event(23, "2024-03-01 15:00:00", 50, 0, 5, uid=77),
    event(24, "2024-03-01 15:00:00", 50, 0, 5, uid=66),
    # bid on an ordinary site: not an anchor there
    event(25, "2024-03-01 15:00:00", 60, 3, 5),
]


def test_edges_by_hand(spark):
    res = run(spark, EDGE_ROWS)
    keyed = by_expid(res)
    assert (10, ts("2024-03-01 05:59:59")) in keyed and (11, ts("2024-03-01 06:00:00")) in keyed
    # click offered to both slots of exposure 12
    r0, r1 = keyed[(12, ts("2024-03-01 05:00:00"))], keyed[(12, ts("2024-03-01 06:30:00"))]
    assert r0[5] == 7200 and r1[5] == 1800
    assert r0[13] == r1[13] == 3232235520 + 5
    assert keyed[(13, ts("2024-03-01 10:20:00"))][5] == -600
    assert keyed[(14, ts("2024-03-01 10:30:00"))][5] == 5400
    ssp1 = keyed[(20, ts("2024-03-01 01:00:00"))]
    assert ssp1[2] == 3 and ssp1[4] == 0 and ssp1[5] == 0 and ssp1[13] == 3232235520 + 12 and ssp1[12] == 0
    ssp2 = keyed[(21, ts("2024-03-01 23:59:59"))]
    assert ssp2[4] == 120 and ssp2[12] == 3232235520 + 15 and ssp2[5] == 7080 and ssp2[15] == dt.date(2024, 3, 1)
    assert not any(r[1] in (0, 30, 31, 60) for r in res)
    late = keyed[(40, ts("2024-03-01 22:30:00"))]
    assert late[5] == 3 * 3600 + 29 * 60 + 59 and late[13] == 3232235520 + 21
    assert keyed[(50, ts("2024-03-01 15:00:00"))][0] == 77


def test_edges_match_brute_force(spark):
    assert run(spark, EDGE_ROWS) == brute_rows(EDGE_ROWS)


def test_every_row_day_is_its_slot_day(spark):
    for r in run(spark, EDGE_ROWS):
        assert r[3].date() == r[15]


def test_fixture_matches_brute_force(spark):
    from adfunnel.sources import fixtures as fx
    from .conftest import SF_SMALL

    h = fx.history_ref_view(spark, SF_SMALL)
    ssp = {r["sid"] for r in fx.ssp_view(spark, SF_SMALL).collect()}
    rows = [r.asDict() for r in h.collect()]
    got = fn.funnel(h, fx.ssp_view(spark, SF_SMALL), tiebreak=["event_id"]).collect()
    got = sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in got), key=repr)
    assert got == sorted(brute.funnel(rows, ssp), key=repr)
    assert len(got) > 100


def test_slot_windows_hold_at_most_two():
    for is_ssp in (False, True):
        for role in (slots.ANCHOR, slots.EXPOSURE, slots.CLICK):
            if (is_ssp, role) not in slots._END_COLUMN:
                continue
            ws = slots.windows(is_ssp, role)
            for t in range(0, slots.DAY, 59):
                assert sum(1 for w in ws if w[2] <= t <= w[3]) <= 2


def test_days_restriction(spark):
    rows = fn.funnel(frame(spark, EDGE_ROWS), ssp_frame(spark, [SSP]), tiebreak=["event_id"],
                     days=[dt.date(2024, 3, 2)]).collect()
    assert rows == []


@pytest.mark.parametrize("branch,tn", [(False, 0), (True, 3)])
def test_branch_only(spark, branch, tn):
    rows = fn.funnel(frame(spark, EDGE_ROWS), ssp_frame(spark, [SSP]), tiebreak=["event_id"],
                     branch=branch).collect()
    assert rows and all(r["tn"] == tn for r in rows)
