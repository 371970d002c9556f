"""The SSP site list with its dates: every load is a version, every day is judged by the list then valid.

Versions lie in a table partitioned by the load date ``d``: a load writes its own date and touches no other, so no copy
of a list is ever replaced by a half-written one.  ``validity`` turns the versions into rows
``(sid, name, valid_from, valid_to)``, disjoint per site (``valid_to`` is open, NULL: still valid):

* a site stays on the list once loaded (the rule of the original, whose loads only add), or
* with ``forget`` a version is the whole list: a site it lacks has left.

Events meet them by an equi-join on the site with the day between both dates: a hash join, broadcast behind a count,
with at most one match for each event and day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import ssp, tables

DATED = ("valid_from", "valid_to")


def add_version(spark: SparkSession, text_path: str, table_path: str, load_date: dt.date) -> tuple[int, int]:
    """Load a list file as the version of ``load_date`` (loaded again: replaced); (sites, rejected lines).

    A list without a valid line is refused: it would take every site off the list.
    """
    good, rejects = ssp.read_ssp_text(spark, text_path, load_date)
    if good.isEmpty():
        raise ValueError(f"{text_path} names no site")
    (good.coalesce(1).sortWithinPartitions("sid").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(table_path))
    sites = spark.read.parquet(tables.partition_path(table_path, ["d"], [load_date])).count()
    return sites, rejects.count()


def read_versions(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema("sid bigint, name string, d date").parquet(table_path)


def validity(versions: DataFrame, forget: bool = False) -> DataFrame:
    """``(sid, name, valid_from, valid_to)`` from versions ``(sid, name, d)``; equal neighbours are one row.

    A site named twice in a version has its greatest name; rows without site or date are left out.
    """
    rows = (versions.where("sid is not null and d is not null").groupBy("sid", "d").agg(F.max("name").alias("name"))
            .withColumnRenamed("d", "valid_from"))
    if forget:
        loads = rows.select("valid_from").distinct()  # a row per load: few
        loads = loads.withColumn("valid_to", F.lead("valid_from").over(W.orderBy("valid_from")))
        rows = rows.join(F.broadcast(loads), "valid_from")
    else:
        rows = rows.withColumn("valid_to", F.lead("valid_from").over(W.partitionBy("sid").orderBy("valid_from")))
    by = W.partitionBy("sid").orderBy("valid_from")
    goes_on = F.lag("valid_to").over(by).eqNullSafe(F.col("valid_from")) & F.lag("name").over(by).eqNullSafe(F.col("name"))
    rows = rows.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(by))
    return rows.groupBy("sid", "_island").agg(
        F.first("name").alias("name"), F.min("valid_from").alias("valid_from"),
        F.max_by("valid_to", "valid_from").alias("valid_to")).select("sid", "name", *DATED)


def list_of(dated: DataFrame, day: dt.date) -> DataFrame:
    """The list ``(sid, name)`` as it was on a day."""
    d = F.lit(day)
    return dated.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (d < F.col("valid_to")))).select("sid", "name")
