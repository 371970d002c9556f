"""Slot assignment from a slot table: data of any size instead of a literal CASE.

A slot table holds, per branch and role, the windows ``(is_ssp, role, slot, lo, hi)`` in seconds from the start of the
processed day, both ends included; ``hi`` may lie days ahead, windows may overlap at will.  The range condition becomes an
equi-join: time of day is cut into bins, a window is listed under each bin it touches, an event looks up its one bin, and the exact
bounds are tested on the matches.  Plan: broadcast hash join (behind a count of the binned table) or a shuffle join; never a
nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import membership, slots

SCHEMA = "is_ssp boolean, role int, slot int, lo bigint, hi bigint"


def standard_slots(spark: SparkSession) -> DataFrame:
    """The slots of ``operators.slots`` as a slot table."""
    rows = [(is_ssp, role, slot, row[0], row[slots._END_COLUMN[is_ssp, role]])
            for is_ssp, role in slots._END_COLUMN for slot, row in enumerate(slots.slot_table(is_ssp))]
    return spark.createDataFrame(rows, SCHEMA)


def binned(slot_table: DataFrame, bin_seconds: int = 900) -> DataFrame:
    """``is_ssp, role, slot, back, from, upto, bin``: each window as a day sees it that lies ``back`` days after the
    processed one, once per bin of that day it touches.  Windows that end before they begin hold nothing."""
    day = slots.DAY
    seen = (slot_table.where("lo <= hi and lo >= 0")
            .withColumn("back", F.explode(F.sequence(F.floor(F.col("lo") / day), F.floor(F.col("hi") / day)))))
    cut = seen.select("is_ssp", "role", "slot", F.col("back").cast("int").alias("back"),
                      F.greatest(F.col("lo") - F.col("back") * day, F.lit(0)).alias("from"),
                      F.least(F.col("hi") - F.col("back") * day, F.lit(day - 1)).alias("upto"))
    first, last = F.floor(F.col("from") / bin_seconds), F.floor(F.col("upto") / bin_seconds)
    return cut.withColumn("bin", F.explode(F.sequence(first, last)))


def assign_slots(df: DataFrame, slot_table: DataFrame, bin_seconds: int = 900, ts_col: str = "sec",
                 ssp_col: str = "is_ssp", role_col: str = "role") -> DataFrame:
    """``slots.assign_slots`` by a slot table: ``slot_d`` and ``slot``, a row per window that holds the event."""
    table = binned(slot_table, bin_seconds)
    table = table.select(*[F.col(c).alias(f"_{c}") for c in table.columns])
    table = F.broadcast(table) if membership.fits_broadcast(table) else table
    tod: Column = slots.second_of_day(F.col(ts_col)).cast("bigint")
    events = df.withColumn("_tod", tod).withColumn("_at", F.floor(F.col("_tod") / bin_seconds))
    holds = ((F.col(ssp_col) == F.col("_is_ssp")) & (F.col(role_col) == F.col("_role"))
             & (F.col("_at") == F.col("_bin")) & F.col("_tod").between(F.col("_from"), F.col("_upto")))
    found = events.join(table, holds)
    return (found.withColumn("slot_d", F.date_sub(F.to_date(ts_col), F.col("_back")))
            .withColumn("slot", F.col("_slot")).select(*df.columns, "slot_d", "slot"))
