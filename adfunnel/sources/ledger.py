"""Ledger of landed files: which file, with which content, was loaded where.

A row per file: path, hour and shard of its load, the ``part`` of the event table that holds its rows, its line
count and digest, its state and the batch that met it; partitioned by day and batch, so a lookup reads the days of the
files in question and a batch that is run again replaces its own rows.

The digest does not depend on the order of the lines: count and sums of two 64-bit hashes, so it is an
aggregation of one row per file, with no file read whole anywhere.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, tsv

#: States of a file.  In the ledger: LOADING (its rows may be in the table), LOADED and DUPLICATE.
NEW, RESUMED, KNOWN, DUPLICATE, CHANGED, LOADING, LOADED = (
    "new", "resumed", "known", "duplicate", "changed", "loading", "loaded")
SCHEMA = ("path string, src_hour timestamp_ntz, shard string, part string, lines bigint, digest string, state string, "
          "d string, batch string")
NO_DAY = "none"


def path_of(table_path: str) -> str:
    """Where the ledger of an event table lies unless named."""
    return table_path.rstrip("/") + "_files"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``value, file, src_hour`` of landed files: each line with its file and the hour named in its path."""
    name = F.col("_metadata.file_path")
    return (spark.read.option("lineSep", "\n").text(list(paths))
            .select("value", name.alias("file"), tsv.hour_key(name).alias("src_hour")))


def part_of(file: Column) -> Column:
    """Partition value of a file's rows; never read as a number."""
    return F.concat(F.lit("p"), F.substring(F.md5(file), 1, 16))


def described(lines: DataFrame) -> DataFrame:
    """``path, src_hour, part, lines, digest`` of every file of ``lines(value, file, src_hour)``.  An empty file has
    no line and so no row: there is nothing to load from it."""
    wide = lambda h: F.sum(h.cast("decimal(38,0)"))
    text = F.coalesce("value", F.lit(""))
    g = lines.groupBy(F.col("file").alias("path"), "src_hour").agg(
        F.count(F.lit(1)).alias("lines"), wide(F.xxhash64(text)).alias("a"), wide(F.xxhash64(text, F.lit(1))).alias("b"))
    digest = F.md5(F.concat_ws(":", F.col("lines").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")))
    return g.select("path", "src_hour", part_of(F.col("path")).alias("part"), "lines", digest.alias("digest"))


def judged(files: DataFrame, known: DataFrame) -> DataFrame:
    """``described`` files with their state, given the ledger rows of the same shard.

    By path: ``known`` if it was loaded with this content (or met as a duplicate), ``resumed`` if that load was cut short,
    ``changed`` if it had another content.  Else by hour and content: ``duplicate`` if another path has brought it, in the ledger or, by the
    least path, among these files.  Else ``new``.
    """
    ours = known.select(F.col("path"), F.col("digest").alias("_digest"), F.col("state").alias("_state"))
    held = (known.where(F.col("state") != DUPLICATE)
            .select(F.col("src_hour").alias("_hour"), F.col("digest").alias("_held")).distinct())
    same_content = F.col("src_hour").eqNullSafe(F.col("_hour")) & (F.col("digest") == F.col("_held"))
    met = files.join(ours, "path", "left").join(held, same_content, "left")
    # of the files no ledger row decides, the least path of a content stands for it
    open_ = F.col("_state").isNull() & F.col("_held").isNull()
    least = (files.join(ours, "path", "left_anti").groupBy(F.col("src_hour").alias("_h"), F.col("digest").alias("_d"))
             .agg(F.min("path").alias("_least")))
    met = met.join(least, F.col("src_hour").eqNullSafe(F.col("_h")) & (F.col("digest") == F.col("_d")), "left")
    state = (F.when(F.col("_state").isNotNull() & (F.col("_digest") != F.col("digest")), CHANGED)
             .when(F.col("_state") == LOADING, RESUMED)
             .when(F.col("_state").isNotNull(), KNOWN)
             .when(~open_ | (F.col("path") != F.col("_least")), DUPLICATE)
             .otherwise(NEW))
    return met.select(*files.columns, state.alias("state"))


def day_label(src_hour: Column) -> Column:
    return F.coalesce(F.date_format(src_hour, "yyyy-MM-dd"), F.lit(NO_DAY))


def entries(spark: SparkSession, path: str, shard: str, days: Iterable[str]) -> DataFrame:
    """Ledger rows of one shard and some days (labels as ``day_label`` gives them)."""
    folders = [p for d in sorted(set(days)) if tables.data_files(spark, p := f"{path.rstrip('/')}/d={d}")]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).option("basePath", path).parquet(*folders).where(F.col("shard") == shard)
    # a load that was resumed has a row in the batch cut short and one in the batch that ended it
    best = F.max_by(F.struct(*rows.columns), F.col("state") != LOADING)
    return rows.groupBy("path").agg(best.alias("r")).select("r.*")


def record(files: DataFrame, path: str, shard: str, batch: str, state: Column) -> None:
    """Write the batch's rows; a batch written again replaces them."""
    rows = files.select("path", "src_hour", F.lit(shard).alias("shard"), "part", "lines", "digest",
                        state.alias("state"), day_label(F.col("src_hour")).alias("d"), F.lit(batch).alias("batch"))
    (rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("d", "batch").parquet(path))


def batch_label(paths: Iterable[str]) -> str:
    """The name of a set of files."""
    import hashlib

    return "b" + hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def day_of(label: str) -> dt.date | None:
    return None if label == NO_DAY else dt.date.fromisoformat(label)
