"""SSP site dimension: load from ``sid<tabs>name`` text.

Runs of tabs collapse to one; a line then needs exactly two fields and a
numeric sid, else it goes to the rejects.  Each row gets the load date.  The
list can name a site twice: the last line wins (the file order is kept by
``monotonically_increasing_id``, which grows with the file offset).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import date_literal


def parse_lines(lines: DataFrame, load_date: dt.date | None = None,
                value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(sid, name, d) rows and rejected lines from a one-column text frame."""
    collapsed = F.regexp_replace(F.col(value_col), "\t+", "\t")
    parts = F.split(collapsed, "\t")
    d = date_literal(load_date) if load_date is not None else F.current_date()
    parsed = lines.select(
        F.col(value_col).alias("line"),
        F.monotonically_increasing_id().alias("_pos"),
        F.size(parts).alias("_n"),
        F.trim(F.get(parts, 0)).try_cast("bigint").alias("sid"),
        F.get(parts, 1).alias("name"),
    )
    ok = (F.col("_n") == 2) & F.col("sid").isNotNull()
    good = (parsed.where(ok).groupBy("sid")
            .agg(F.max_by("name", "_pos").alias("name"))
            .withColumn("d", d))
    rejects = parsed.where(~ok).select("line")
    return good, rejects


def read_ssp_text(spark: SparkSession, path: str, load_date: dt.date | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    return parse_lines(spark.read.text(path), load_date)


def merge_sites(current: DataFrame | None, new: DataFrame) -> DataFrame:
    """Sites of both, the newest row per sid (a reload never forgets a site)."""
    if current is None:
        return new
    both = current.select("sid", "name", "d", F.lit(0).alias("_src")).unionByName(
        new.select("sid", "name", "d", F.lit(1).alias("_src")))
    newest = F.max_by(F.struct("name", "d"), F.struct("d", "_src"))
    return both.groupBy("sid").agg(newest.alias("_n")).select("sid", "_n.name", "_n.d")


def load_sites(spark: SparkSession, text_path: str, table_path: str,
               load_date: dt.date | None = None) -> tuple[int, int]:
    """Load a site list file into the SSP table: merge, write the new list beside the old, then switch.

    The old copy stays until the new one is whole (``tables.switch_folder``); a switch that was cut short is settled by
    the next load.  Returns (sites in the table, rejected lines).
    """
    from . import tables

    tables.settle_folder(spark, table_path)
    new, rejects = read_ssp_text(spark, text_path, load_date)
    beside = table_path.rstrip("/") + "__new"
    merged = merge_sites(tables.read_if_exists(spark, table_path), new)
    merged.write.mode("overwrite").parquet(beside)
    sites = spark.read.parquet(beside).count()
    tables.switch_folder(spark, beside, table_path)
    spark.catalog.refreshByPath(table_path)
    return sites, rejects.count()
