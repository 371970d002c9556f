"""The daily funnel: bid -> impression -> click per exposure and slot.

Plan (one scan, one shuffle):

    scan history_ref (d pruned)            narrow
      -> valid events (sn = 0, expid != 0, tn in 0/1/3)
      -> is_ssp by broadcast left join with the (checked-size) SSP site list
      -> role per branch, one or two slots per event (CASE + explode)
      -> partial aggregate per (is_ssp, slot_d, slot, expid)    map side
      -> exchange on the group key
      -> final aggregate, anchor present                          reduce side

The self-join of bids, impressions and clicks is an aggregation: per group the
earliest anchor, the earliest SSP impression and the earliest click, each as
``min(struct(sec, tie-break..., payload))``.  The minimum is exact and
deterministic: ties on ``sec`` are broken by the tie-break columns and then by
the payload itself.  All aggregates combine map-side, so a hot exposure id is
reduced inside each map task before it reaches the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from . import membership, slot_join, slots

ANCHOR_PAYLOAD = ["uid", "sid", "sz", "geo", "bt", "ref", "bref", "ipint"]
FOLLOWER_PAYLOAD = ["ipint"]


def valid_events(events: DataFrame) -> DataFrame:
    """Events the funnel accepts: status 0, a real exposure id, a bid/impression/click."""
    return events.where(
        (F.col("sn") == schema.SN_OK)
        & (F.col("expid") != 0)
        & F.col("tn").isin(schema.TN_IMPRESSION, schema.TN_CLICK, schema.TN_BID)
    )


def role(is_ssp: Column, tn: Column) -> Column:
    """Role of an event in its branch; NULL for types the branch ignores.

    Ordinary sites: impression anchors, click follows.  SSP sites: bid anchors,
    impression and click follow.  A bid on an ordinary site plays no part.
    """
    return (F.when(is_ssp & (tn == schema.TN_BID), F.lit(slots.ANCHOR))
            .when(is_ssp & (tn == schema.TN_IMPRESSION), F.lit(slots.EXPOSURE))
            .when(~is_ssp & (tn == schema.TN_IMPRESSION), F.lit(slots.ANCHOR))
            .when(tn == schema.TN_CLICK, F.lit(slots.CLICK)))


def branch_rows(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """Valid events with ``is_ssp`` and ``role``: the union of all branch inputs."""
    marked = membership.mark_ssp(valid_events(events), ssp_sites)
    return (marked.withColumn("role", role(F.col("is_ssp"), F.col("tn")))
            .where(F.col("role").isNotNull()))


def _earliest(r: int, fields: Sequence[str]) -> Column:
    """Earliest row of role ``r`` in the group as a struct (NULL if none)."""
    return F.min(F.when(F.col("role") == r, F.struct(*[F.col(c) for c in fields])))


GROUP_KEY = ["is_ssp", "slot_d", "slot", "expid"]


def slot_rows(events: DataFrame, ssp_sites: DataFrame, days: Sequence | None = None,
              branch: bool | None = None, slot_table: DataFrame | None = None) -> DataFrame:
    """Valid events of the branches with the group they belong to (``GROUP_KEY``) and their role.

    ``ssp_sites`` may be a dated list: each processed day then goes by the list valid on it, so an event after
    midnight can be of one branch for the day before and of the other for its own.
    ``slot_table``: slots as data (``slot_join``) instead of the standard ones; not with a dated list.
    """
    if slot_table is not None:
        rows = branch_rows(events, ssp_sites)
        rows = rows if branch is None else rows.where(F.col("is_ssp") == F.lit(branch))
        rows = slot_join.assign_slots(rows, slot_table)
        return rows if days is None else rows.where(F.col("slot_d").isin(list(days)))
    if membership.is_dated(ssp_sites):
        own = F.to_date("sec")
        late = F.array(own, F.date_sub(own, 1))
        days_read = F.when(F.hour("sec") < slots.LOOKAHEAD_HOURS, late).otherwise(F.array(own))
        marked = membership.mark_ssp_asof(valid_events(events).withColumn("_day", F.explode(days_read)), ssp_sites, "_day")
        rows = marked.withColumn("role", role(F.col("is_ssp"), F.col("tn"))).where(F.col("role").isNotNull())
    else:
        rows = branch_rows(events, ssp_sites)
    if branch is not None:
        rows = rows.where(F.col("is_ssp") == F.lit(branch))
    rows = slots.assign_slots(rows)
    if "_day" in rows.columns:
        rows = rows.where(F.col("_day") == F.col("slot_d")).drop("_day")
    return rows if days is None else rows.where(F.col("slot_d").isin(list(days)))


def stitch(rows: DataFrame, tiebreak: Sequence[str] = (), also: Sequence[str] = ()) -> DataFrame:
    """Funnel rows from ``slot_rows``: one per group that holds an anchor.  ``also``: columns that follow from the group,
    as further keys (a stream's watermark column)."""
    tb = list(tiebreak)
    # only the anchor's strings are read: the others are blanked before the sort of the partial aggregation
    rows = rows.withColumns({c: F.when(F.col("role") == slots.ANCHOR, F.col(c)) for c in ("ref", "bref")})
    g = rows.groupBy(*also, *GROUP_KEY).agg(
        _earliest(slots.ANCHOR, ["sec", *tb, *ANCHOR_PAYLOAD]).alias("a"),
        _earliest(slots.EXPOSURE, ["sec", *tb, *FOLLOWER_PAYLOAD]).alias("e"),
        _earliest(slots.CLICK, ["sec", *tb, *FOLLOWER_PAYLOAD]).alias("c"),
    ).where(F.col("a").isNotNull())
    return shape(g)


def funnel(events: DataFrame, ssp_sites: DataFrame, tiebreak: Sequence[str] = (),
           days: Sequence | None = None, branch: bool | None = None,
           slot_table: DataFrame | None = None) -> DataFrame:
    """Funnel rows (``schema.FUNNEL_COLUMNS``) for the events given.

    ``events`` holds the 22 event columns (plus the ``tiebreak`` columns).
    ``days``: restrict to slots of these processed days; the caller should
    also prune the scan to those days and the next one (late followers).
    ``branch``: only SSP sites (True), only the others (False), or both.
    """
    return stitch(slot_rows(events, ssp_sites, days, branch, slot_table), tiebreak)


def _seconds_between(a: Column, b: Column) -> Column:
    """b - a in seconds; on timestamp_ntz this is wall-clock and zone-free."""
    return (F.unix_timestamp(b) - F.unix_timestamp(a)).cast("int")


def shape(g: DataFrame) -> DataFrame:
    """Aggregated groups -> funnel columns (both branches in one projection)."""
    ssp = F.col("is_ssp")
    a, e, c = F.col("a"), F.col("e"), F.col("c")
    imp_sec = F.when(ssp, e["sec"]).otherwise(a["sec"])
    return g.select(
        a["uid"].alias("uid"),
        F.col("expid"),
        F.when(ssp, F.lit(schema.TN_BID)).otherwise(F.lit(schema.TN_IMPRESSION)).cast("tinyint").alias("tn"),
        a["sec"].alias("sec"),
        F.when(ssp & e.isNotNull(), _seconds_between(a["sec"], e["sec"]))
        .otherwise(F.lit(0)).cast("int").alias("delta30"),
        F.when(imp_sec.isNotNull() & c.isNotNull(), _seconds_between(imp_sec, c["sec"]))
        .otherwise(F.lit(0)).cast("int").alias("delta01"),
        a["ref"].alias("ref"),
        a["sid"].alias("sid"),
        a["sz"].alias("sz"),
        a["bref"].alias("bref"),
        a["geo"].alias("geo"),
        F.when(ssp, a["ipint"]).otherwise(F.lit(0)).cast("bigint").alias("ipint_bid"),
        F.when(ssp, F.coalesce(e["ipint"], F.lit(0))).otherwise(a["ipint"]).cast("bigint").alias("ipint_exp"),
        F.coalesce(c["ipint"], F.lit(0)).cast("bigint").alias("ipint_cl"),
        a["bt"].alias("bt"),
        F.col("slot_d").alias("d"),
    )
