"""Event and funnel tables on Parquet: DDL, partitioned writes, shard union.

Layout: the event table is partitioned by day and hour ``(d, h)`` and sorted
inside each file by ``(sid, dom, sz, uid)`` so Parquet min/max statistics
skip row groups for site and domain filters; the funnel table is partitioned
by ``d`` and sorted by ``uid``.  Writes overwrite only the partitions present
in the data (dynamic partition overwrite), so a rerun of an hour or a day
replaces it instead of adding to it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import derive

EVENT_SORT = ["sid", "dom", "sz", "uid"]
#: Columns looked up by value though files are not sorted by them: Parquet keeps a Bloom filter per row group.
LOOKUP = ["expid", "uid"]
#: Most bytes of one such filter; it shrinks to the distinct values found.
BLOOM_BYTES = 1 << 20
#: User ids modulo this are stored in the bucketed layout; samples of any of its divisors read whole buckets.
SAMPLE_MODULUS = 240
SALT_SEED = 17
FUNNEL_SORT = ["uid"]


def event_table_frame(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """22 stored columns + dom, refhash, d, h in table order (+ ``keep`` columns first)."""
    derived = derive.with_event_columns(events.select(*keep, *schema.EVENT_COLUMNS))
    return derived.select(*keep, *schema.EVENT_COLUMNS, "dom", "refhash", "d", "h")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder and when each was written; empty when the folder is absent."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    out, files = {}, fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().getName()
        if not name.startswith(("_", ".")):
            out[f.getPath().toString()] = f.getModificationTime()
    return out


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a data file lies below a folder; the listing stops at the first."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def _key_folders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Values and paths of the ``key=value`` folders directly below ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    out = {}
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(key + "="):
            out[name[len(key) + 1:]] = s.getPath().toString()
    return out


def listed_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days with data of a table partitioned by ``d``, from its folders: no data file is opened."""
    return sorted(dt.date.fromisoformat(v) for v, p in _key_folders(spark, path, "d").items()
                  if has_data(spark, p))


def listed_hours(spark: SparkSession, path: str, day: dt.date) -> list[int]:
    """Hours with data of one day of a table partitioned by ``(d, h)``, from its folders."""
    return sorted(int(v) for v, p in _key_folders(spark, partition_path(path, ["d"], [day]), "h").items()
                  if has_data(spark, p))


def shard_label(ug_from: int, ug_to: int) -> str:
    """Partition value of the load unit that holds these user groups."""
    return f"g{ug_from:03d}_{ug_to:03d}"


def listed_shards(spark: SparkSession, path: str, day: dt.date, hour: int) -> list[str]:
    """Load units with data of one hour; a file outside such a unit is an error of the layout."""
    folder = partition_path(path, ["d", "h"], [day, hour])
    units = {v: data_files(spark, p) for v, p in _key_folders(spark, folder, "shard").items()}
    if len(data_files(spark, folder)) > sum(map(len, units.values())):
        raise ValueError(f"{folder} holds files outside its load units")
    return sorted(v for v, files in units.items() if files)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder (a staging table after its publish); True if it existed."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))


def _fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def switch_folder(spark: SparkSession, new: str, path: str) -> None:
    """Let the finished folder ``new`` take the place of ``path``; at every moment one whole copy is there.

    The old copy is set aside as ``<path>__old`` and removed last, so ``settle_folder`` can finish or undo a switch that was
    cut short.
    """
    fs, old = _fs_path(spark, path.rstrip("/") + "__old")
    target, source = _fs_path(spark, path)[1], _fs_path(spark, new)[1]
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(source, target):
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(old, True)


def settle_folder(spark: SparkSession, path: str) -> None:
    """After a switch that was cut short: the old copy goes if the new one is in place, else it comes back."""
    fs, old = _fs_path(spark, path.rstrip("/") + "__old")
    if fs.exists(old):
        target = _fs_path(spark, path)[1]
        if fs.exists(target):
            fs.delete(old, True)
        elif not fs.rename(old, target):
            raise OSError(f"cannot bring {path} back")


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def partition_path(path: str, keys: Sequence[str], values: Sequence) -> str:
    parts = [f"{k}={v:%Y-%m-%d}" if isinstance(v, dt.date) else f"{k}={v}" for k, v in zip(keys, values)]
    return "/".join([path.rstrip("/"), *parts])


def read_partitions(spark: SparkSession, path: str, keys: Sequence[str],
                    values: Iterable[Sequence]) -> DataFrame | None:
    """Only the named partitions of a table, by their folders (``basePath`` keeps
    the partition columns).  Lists those folders alone, not the whole table:
    the cost follows the partitions touched, not the table size.  None if none
    of them holds data."""
    paths = [p for p in (partition_path(path, keys, v) for v in values) if has_data(spark, p)]
    if not paths:
        return None
    return spark.read.option("basePath", path).parquet(*paths)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      sort_cols: Sequence[str], cluster_partitions: int | None = None,
                      cluster: bool = True, scan: bool = False) -> None:
    """Dynamic partition overwrite of ``path``.

    With ``cluster`` (default) the rows are first range-partitioned on
    (partition cols + sort cols + a salt): one shuffle with sampled bounds, so
    a large hour is split over many tasks (a hot site by its zones and users,
    a mass of identical rows by the salt), a small one stays in one task, and every file covers a narrow key range for
    min/max skipping.  ``cluster_partitions`` sets the number of ranges
    (default ``spark.sql.shuffle.partitions``).  The number is explicit on
    purpose: AQE would coalesce a small shuffle into one task, and one task
    writing hundreds of partition folders runs them one after the other.
    Size it from the data at scale (e.g. bytes of the hour / 256 MB).
    Without ``cluster`` the write is narrow: each task sorts and writes its
    own rows.  ``scan``: ``df`` reads files with no shuffle before, so a task that is run
    again sees its rows in the same order and a seeded random salt repeats; after a shuffle
    it would not, and the salt is a hash of the row.
    """
    if cluster:
        keys = [*partition_cols, *sort_cols]
        n = cluster_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # last range key: a salt, so a mass of rows with one key (a third of an hour)
        # is cut into several ranges
        salt = F.rand(SALT_SEED) if scan else F.xxhash64(*df.columns)
        df = (df.withColumn("_salt", salt)
              .repartitionByRange(n, *keys, "_salt").drop("_salt"))
    writer = (df.sortWithinPartitions(*partition_cols, *sort_cols)
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic"))
    for c in set(LOOKUP) & set(df.columns):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true") \
        .option("parquet.bloom.filter.max.bytes", str(BLOOM_BYTES))
    writer.partitionBy(*partition_cols).parquet(path)


def write_events(events: DataFrame, path: str, cluster_partitions: int | None = None) -> None:
    write_partitioned(event_table_frame(events), path, ["d", "h"], EVENT_SORT, cluster_partitions)


def write_funnel(funnel: DataFrame, path: str, cluster_partitions: int | None = None) -> None:
    write_partitioned(funnel.select(*schema.FUNNEL_COLUMNS), path, ["d"], FUNNEL_SORT, cluster_partitions)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def trace(events: DataFrame, expids: Iterable[int]) -> DataFrame:
    """All events of a few exposures, in time order.  The ids reach the Parquet reader, which skips by Bloom filter the row
    groups that hold none of them."""
    wanted = sorted({int(i) for i in expids})
    return events.where(F.col("expid").isin(wanted)).orderBy("expid", "sec")


def sample_bucket(uid: F.Column) -> F.Column:
    """The unsigned user id modulo ``SAMPLE_MODULUS``."""
    wrapped = F.when(uid < 0, F.lit(2 ** 64 % SAMPLE_MODULUS)).otherwise(F.lit(0))
    return F.pmod(F.pmod(uid, F.lit(SAMPLE_MODULUS)) + wrapped, F.lit(SAMPLE_MODULUS)).cast("int")


def create_sampled_table(spark: SparkSession, name: str, location: str, buckets: int = 60) -> None:
    """A catalog table of events, partitioned by ``(d, h)`` and bucketed by ``ub``, the user's sample bucket."""
    columns = _ddl_columns(schema.EVENT_FIELDS) + ", dom string, refhash string, ub int, d date, h int"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (d, h) "
              f"CLUSTERED BY (ub) SORTED BY (ub, uid) INTO {buckets} BUCKETS LOCATION '{location}'")


def write_sampled(events: DataFrame, name: str) -> None:
    """Write hours of events to a table of ``create_sampled_table``; the partitions named are replaced."""
    spark = events.sparkSession
    rows = event_table_frame(events).withColumn("ub", sample_bucket(F.col("uid")))
    order = [f.name for f in spark.table(name).schema.fields]
    # one task per bucket and hour: a bucket of an hour is one file
    (rows.select(*order).repartition("d", "h", "ub").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True))


def read_sample(spark: SparkSession, name: str, buckets: int, bucket: int) -> DataFrame:
    """The events of users with ``uid % buckets = bucket`` (unsigned), as ``derive.user_sample`` picks them.

    ``buckets`` divides ``SAMPLE_MODULUS``: the sample is some values of the bucketed column, so only their buckets are read.
    """
    if not 0 <= bucket < buckets:
        raise ValueError("bucket must lie in [0, buckets)")
    rows = spark.table(name)
    if SAMPLE_MODULUS % buckets:
        raise ValueError(f"buckets must divide {SAMPLE_MODULUS}")
    return rows.where(F.col("ub").isin(list(range(bucket, SAMPLE_MODULUS, buckets))))


def union_shards(frames: Sequence[DataFrame]) -> DataFrame:
    """One logical table over shard tables (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def shard_of(uid_col: str = "uid") -> F.Column:
    """Shard number of a row from its user group (1..128 -> 1, 129..256 -> 2)."""
    ug = derive.user_group(F.col(uid_col))
    expr = None
    for shard, (lo, hi) in schema.SHARD_GROUPS.items():
        expr = F.when(ug.between(lo, hi), F.lit(shard)) if expr is None else expr.when(ug.between(lo, hi), F.lit(shard))
    return expr


# ---------------------------------------------------------------- DDL


def _ddl_columns(fields) -> str:
    return ", ".join(f"`{n}` {t.simpleString()}" for n, t in fields)


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Create the database and the three tables if absent (idempotent)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ev = _ddl_columns(schema.EVENT_FIELDS) + ", dom string, refhash string, d date, h int, shard string"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.history_ref ({ev}) USING parquet "
              f"PARTITIONED BY (d, h, shard) LOCATION '{location}/history_ref'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.history_uid ({_ddl_columns(schema.FUNNEL_FIELDS)}) "
              f"USING parquet PARTITIONED BY (d) LOCATION '{location}/history_uid'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.ssp_sites (sid bigint, name string, d date) "
              f"USING parquet LOCATION '{location}/ssp_sites'")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Rollback of a table."""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
