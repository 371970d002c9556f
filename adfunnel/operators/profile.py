"""Volume profiles and day/hour bookkeeping aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from . import membership


def profiled_events(events: DataFrame) -> DataFrame:
    """Events the daily profile counts: status 0 and a real exposure id (any type)."""
    return events.where((F.col("sn") == schema.SN_OK) & (F.col("expid") != 0))


def with_day(events: DataFrame) -> DataFrame:
    return events if "d" in events.columns else events.withColumn("d", F.to_date("sec"))


def volume_by_site(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """Rows per (d, sid) of ordinary (non-SSP) sites, ordered."""
    rows = membership.without_ssp(with_day(profiled_events(events)), ssp_sites)
    return rows.groupBy("d", "sid").agg(F.count(F.lit(1)).alias("n")).orderBy("d", "sid")


def volume_by_site_zone(events: DataFrame, ssp_sites: DataFrame) -> DataFrame:
    """Rows per (d, sid, sz) of SSP sites, ordered."""
    rows = membership.only_ssp(with_day(profiled_events(events)), ssp_sites)
    return rows.groupBy("d", "sid", "sz").agg(F.count(F.lit(1)).alias("n")).orderBy("d", "sid", "sz")


def volume_by_site_asof(events: DataFrame, dated: DataFrame) -> DataFrame:
    """Rows per (d, sid) with the branch the site was in on that day, by a dated SSP list.

    Rows are counted first, so the list meets a row per day and site.
    """
    counted = with_day(profiled_events(events)).groupBy("d", "sid").agg(F.count(F.lit(1)).alias("n"))
    return membership.mark_ssp_asof(counted, dated, "d").select("d", "sid", "is_ssp", "n").orderBy("d", "sid")


def hours_per_day(events: DataFrame) -> DataFrame:
    """Distinct hours per day (exact; at most 24 values, deduplicated map-side)."""
    e = with_day(events)
    h = F.col("h") if "h" in e.columns else F.hour("sec")
    return (e.select("d", h.alias("h")).distinct()
            .groupBy("d").agg(F.count(F.lit(1)).alias("n_hours")))


def distinct_days(events: DataFrame) -> DataFrame:
    return with_day(events).select("d").distinct()


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n"))
