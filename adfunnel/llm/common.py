"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfunnel.session import new_scratch_path

#: The white space of words and lines: space and U+0009 to U+000D (fixed values).
WS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
#: Rows of a file of a table whose number of rows is known.
ROWS_A_FILE = 50_000


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per session, however it came to the driver.

    The archive is read by the driver alone, whose file server hands it to the executors.
    """
    sc = spark.sparkContext
    if any(f.endswith("/adfunnel.zip") for f in sc.listFiles):
        return
    package = Path(__file__).parents[1]
    folder = Path(tempfile.mkdtemp(prefix="adfunnel-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, folder / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(folder / "adfunnel"), "zip", folder / "src"))


def written(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage cut that survives lost
    executors, and a table that later steps may read several times.

    ``most``: no more rows than that are known to come.  They go into files of ``ROWS_A_FILE``, one per core at least,
    instead of one per shuffle partition; on a local disk each file makes its executor start two processes (``chmod``).
    Only for the result of an aggregation, whose rows are dealt evenly."""
    spark = df.sparkSession
    if most is not None:
        df = joined_up(df, most)
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def joined_up(df: DataFrame, most: int) -> DataFrame:
    """``df``, of ``most`` small rows at most, in partitions of ``ROWS_A_FILE``, but one per core at least; no shuffle."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // ROWS_A_FILE)))


def whole_text(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """The runs of non-white characters of a text, in order; none for a null or blank text."""
    spaced = F.coalesce(text, F.lit(""))
    for c in WS[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    # a split at one fixed character takes no regular expression
    return F.array_remove(F.split(spaced, " ", -1), "")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key that tells documents apart: id and text.  Rows that share it are repeated rows, for
    which every operator here decides alike."""
    return F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                       F.md5(F.coalesce(F.col(text_col), F.lit("\x00"))))


def ordered_totals(df: DataFrame, keys: list[str], sums: dict[str, Column], name: str,
                   group: list[str] | None = None) -> DataFrame:
    """``df`` with, per entry of ``sums``, the total over all rows before it in the order of ``keys``
    (within ``group``, whose columns must lead ``keys``).

    A distributed prefix sum: the rows are range-partitioned and written once, the totals of the
    partitions (one row per partition and group) are summed up, and a running sum inside each
    partition is added to them.  A hot group is cut over many partitions; no task sees a group as
    a whole.  ``keys`` must make a total order up to rows that are interchangeable.
    """
    group = group or []
    cols = [F.col(k).asc_nulls_last() for k in keys]
    laid = written(
        df.repartitionByRange(*cols).sortWithinPartitions(*cols)
        .withColumns({f"__v_{k}": v for k, v in sums.items()})
        .withColumn("__pid", F.spark_partition_id()), name)
    totals = laid.groupBy("__pid", *group).agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    earlier = W.partitionBy(*group).orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(
        F.col("__pid").alias("__bpid"), *[F.col(g).alias(f"__b_{g}") for g in group],
        *[F.coalesce(F.sum(f"__t_{k}").over(earlier), F.lit(0)).alias(f"__p_{k}") for k in sums])
    same = F.col("__pid") == F.col("__bpid")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__b_{g}"))
    running = W.partitionBy("__pid", *group).orderBy(*cols).rowsBetween(W.unboundedPreceding, -1)
    out = laid.withColumns({f"__r_{k}": F.coalesce(F.sum(f"__v_{k}").over(running), F.lit(0)) for k in sums})
    # without groups one row per partition, far below any broadcast limit
    out = out.join(before if group else F.broadcast(before), same)
    return out.select(*df.columns, *[(F.col(f"__p_{k}") + F.col(f"__r_{k}")).alias(k) for k in sums])
