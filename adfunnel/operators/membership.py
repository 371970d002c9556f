"""Membership tests: site lists, (site, zone) pairs, and the SSP split.

Broadcast policy: a side is broadcast only behind a row-count check.  For a
dimension frame the check is one small job (``limit(n + 1).count()``),
remembered per DataFrame object so a session pays it once.  Above the bound
no hint is given and the planner chooses (a shuffle join, or a broadcast if
its size estimate or AQE's runtime size says it fits).  Without the check a
frame with no size statistics (e.g. built from Python rows) would plan as a
sort-merge join that shuffles the whole event side first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row bound below which a key list is broadcast.  A (bigint, boolean) key row
# costs a few tens of bytes in the broadcast hash relation.
BROADCAST_MAX_ROWS = 2_000_000

def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (checked once per frame)."""
    known = df.__dict__.setdefault("_adfunnel_fits", {})  # goes when the frame goes
    if max_rows not in known:
        known[max_rows] = df.limit(max_rows + 1).count() <= max_rows
    return known[max_rows]


def bounded_broadcast(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its known row count is at most ``max_rows``."""
    return F.broadcast(df) if n_rows <= max_rows else df


def ssp_keys(ssp_sites: DataFrame) -> DataFrame:
    """Distinct SSP site ids, flagged; broadcast when the dimension is small.

    The row count of the dimension bounds its distinct ids, so the check runs
    on the input frame (remembered) rather than on this derived one.
    """
    keys = ssp_sites.select(F.col("sid").cast("bigint").alias("sid")).distinct() \
        .withColumn("is_ssp", F.lit(True))
    return F.broadcast(keys) if fits_broadcast(ssp_sites) else keys


def mark_ssp(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """Add boolean ``is_ssp``: one left join instead of a semi and an anti join."""
    return (events.join(ssp_keys(ssp_sites), "sid", "left")
            .withColumn("is_ssp", F.coalesce(F.col("is_ssp"), F.lit(False))))


def is_dated(ssp_sites: DataFrame) -> bool:
    """Whether the list says from when to when a site is on it (``sources.ssp_history.validity``)."""
    return {"valid_from", "valid_to"} <= set(ssp_sites.columns)


def mark_ssp_asof(events: DataFrame, dated: DataFrame, day_col: str) -> DataFrame:
    """``mark_ssp`` by the list that was valid on each row's day."""
    spans = dated.select(F.col("sid").cast("bigint").alias("_sid"), F.col("valid_from").alias("_from"),
                         F.col("valid_to").alias("_to"))
    spans = F.broadcast(spans) if fits_broadcast(dated) else spans
    day = F.col(day_col)
    valid = (F.col("sid") == F.col("_sid")) & (day >= F.col("_from")) & (F.col("_to").isNull() | (day < F.col("_to")))
    return events.join(spans, valid, "left").withColumn("is_ssp", F.col("_sid").isNotNull()).drop("_sid", "_from", "_to")


def only_ssp(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """``sid IN (SELECT sid FROM ssp_sites)`` as a left semi join."""
    return events.join(ssp_keys(ssp_sites).select("sid"), "sid", "left_semi")


def without_ssp(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """``sid NOT IN (SELECT sid FROM ssp_sites)`` as a left anti join.

    NOT IN would return nothing if the list held a NULL; ids are never NULL
    here, and the anti join keeps the intended meaning either way.
    """
    return events.join(ssp_keys(ssp_sites).select("sid"), "sid", "left_anti")


def sites_in(events: DataFrame, sids: Iterable[int]) -> DataFrame:
    """Literal list membership ``sid IN (...)``; pushed to the parquet scan."""
    return events.where(F.col("sid").isin([int(s) for s in sids]))


def site_zones_in(events: DataFrame, spark: SparkSession,
                  pairs: Sequence[tuple[int, Sequence[int] | None]]) -> DataFrame:
    """Membership on (site, zones): ``OR`` of ``sid = s [AND sz IN (...)]``.

    ``pairs`` holds (sid, zones) with zones ``None`` for "every zone".  Short
    lists become one predicate (pushed down); long lists a semi join on a key
    table, which stays correct for any size.
    """
    if sum(1 + len(z or ()) for _, z in pairs) <= 1000:
        cond = None
        for sid, zones in pairs:
            term = F.col("sid") == F.lit(int(sid))
            if zones is not None:
                term = term & F.col("sz").isin([int(z) for z in zones])
            cond = term if cond is None else cond | term
        return events.where(cond if cond is not None else F.lit(False))
    key_rows = ([(int(s), None) for s, z in pairs if z is None]
                + [(int(s), int(z)) for s, zs in pairs if zs is not None for z in zs])
    keys = spark.createDataFrame(key_rows, "sid bigint, sz bigint")
    # equi-join on sid, zone test as a join condition; a semi join never duplicates
    k = bounded_broadcast(keys, len(key_rows)).alias("k")
    return events.alias("e").join(
        k, (F.col("e.sid") == F.col("k.sid")) & (F.col("k.sz").isNull() | (F.col("e.sz") == F.col("k.sz"))),
        "left_semi")
