"""Table lifecycle: which hours and days are loaded, completeness, fill cap,
retention, cutting days out, and publishing a staged hour with reconciliation.

Set-valued checks are DataFrames built on the distinct ``(d, h)`` keys of a
table; they are small (at most 24 rows per day) whatever the table size.
Only decisions (booleans, day lists bounded by the calendar) reach the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions.derive import date_literal
from ..operators import profile
from ..sources import tables

DAY_FORMAT = re.compile(r"^\d{4}-\d{2}-\d{2}$")


class LifecycleError(RuntimeError):
    pass


def parse_day(text: str | dt.date) -> dt.date:
    if isinstance(text, dt.date):
        return text
    if not DAY_FORMAT.match(text):
        raise ValueError(f"day must be yyyy-mm-dd: {text!r}")
    return dt.date.fromisoformat(text)


# ---------------------------------------------------------------- lists


def day_list(spark: SparkSession, today: dt.date, n: int = schema.BACKFILL_DAYS) -> DataFrame:
    """The ``n`` days before ``today`` (``today`` excluded), ascending."""
    return spark.range(1).select(F.explode(F.sequence(
        F.date_sub(date_literal(today), n), F.date_sub(date_literal(today), 1))).alias("d"))


def hour_list(days: DataFrame) -> DataFrame:
    """The 24 ``(d, h)`` keys of every day in ``days``."""
    return days.select("d", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))


def loaded_hours(table: DataFrame) -> DataFrame:
    """Distinct (d, h) of a table (partition columns when it has them)."""
    t = profile.with_day(table)
    h = F.col("h") if "h" in t.columns else F.hour("sec")
    return t.select("d", h.alias("h")).distinct()


# ---------------------------------------------------------------- checks


def hours_present(table: DataFrame, days: DataFrame) -> DataFrame:
    """Every hour of ``days`` with ``present`` = loaded in ``table``."""
    keys = loaded_hours(table).withColumn("present", F.lit(True))
    return (hour_list(days).join(keys, ["d", "h"], "left")
            .select("d", "h", F.coalesce("present", F.lit(False)).alias("present")))


def hour_present(table: DataFrame, hour: dt.datetime) -> bool:
    """Probe one hour: a partition-pruned ``LIMIT 1``."""
    day = hour.date()
    t = table if "h" in table.columns else table.withColumn("h", F.hour("sec"))
    t = profile.with_day(t)
    return not t.where((F.col("d") == date_literal(day)) & (F.col("h") == hour.hour)).limit(1).isEmpty()


def missing_days(table: DataFrame, days: DataFrame) -> DataFrame:
    return days.join(profile.distinct_days(table), "d", "left_anti")


def missing_hours(table: DataFrame, days: DataFrame) -> DataFrame:
    return hour_list(days).join(loaded_hours(table), ["d", "h"], "left_anti")


def completeness(table: DataFrame) -> DataFrame:
    """Per day: distinct hours and whether all 24 are there (the build gate)."""
    return (profile.hours_per_day(table)
            .withColumn("complete", F.col("n_hours") == 24))


def day_is_complete(table: DataFrame, day: dt.date) -> bool:
    t = profile.with_day(table).where(F.col("d") == date_literal(day))
    row = profile.hours_per_day(t).first()
    return bool(row and row["n_hours"] == 24)


def fill_state(table: DataFrame, cap: int = schema.FILL_CAP_DAYS) -> DataFrame:
    """One row: distinct days held and whether more may be added (< cap)."""
    return (profile.distinct_days(table).agg(F.count(F.lit(1)).alias("n_days"))
            .withColumn("need_fill", F.col("n_days") < cap))


def need_fill(table: DataFrame, cap: int = schema.FILL_CAP_DAYS) -> bool:
    return bool(fill_state(table, cap).first()["need_fill"])


def ranked_days(table: DataFrame) -> DataFrame:
    """Distinct days with their rank from the newest (1 = newest).

    The window has no partition key, so it runs in one task; its input is the
    distinct days of the table, bounded by the calendar, not by the data.
    """
    w = Window.orderBy(F.col("d").desc())
    return profile.distinct_days(table).withColumn("age", F.row_number().over(w))


def expired_days(table: DataFrame, keep: int = schema.RETENTION_DAYS) -> DataFrame:
    """Days beyond the newest ``keep`` (the oldest n - keep days)."""
    return ranked_days(table).where(F.col("age") > keep).select("d")


def kept_days(table: DataFrame, keep: int = schema.RETENTION_DAYS) -> DataFrame:
    return ranked_days(table).where(F.col("age") <= keep).select("d")


def kept_day_counts(table: DataFrame, keep: int = schema.RETENTION_DAYS) -> DataFrame:
    """Rows per day for the newest ``keep`` days.

    Counts per day first (partial aggregation: one row per day and task),
    then ranks the per-day rows; no join of the table with the day list.
    """
    per_day = profile.with_day(table).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.col("d").desc())
    return per_day.withColumn("age", F.row_number().over(w)).where(F.col("age") <= keep).select("d", "n")


def outside_days(table: DataFrame, first: str | dt.date, last: str | dt.date | None = None) -> DataFrame:
    """The table without the days ``first .. last`` (``last`` defaults to ``first``)."""
    lo = parse_day(first)
    hi = parse_day(last) if last is not None else lo
    if hi < lo:
        raise ValueError("last day before first day")
    return profile.with_day(table).where(~F.col("d").between(date_literal(lo), date_literal(hi)))


# ---------------------------------------------------------------- physical changes


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def drop_day_partitions(spark: SparkSession, path: str, days: Iterable[dt.date]) -> int:
    """Delete the ``d=<day>`` partition folders of a table; returns how many existed."""
    fs, jvm = _fs(spark, path)
    n = 0
    for d in days:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/d={d:%Y-%m-%d}")
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def table_location(spark: SparkSession, table: str) -> str:
    """Storage folder of a catalog table."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    raise LifecycleError(f"no location for {table}")


def drop_table_days(spark: SparkSession, table: str, days: Iterable[dt.date]) -> int:
    """Remove days from a catalog table partitioned by ``d`` (and ``h``).

    Deletes the day folders under the table location, drops the partition
    entries where the catalog tracks them (a metastore does; the in-memory
    catalog lists folders), and refreshes the cached file listing.
    """
    days = list(days)
    n = drop_day_partitions(spark, table_location(spark, table), days)
    for d in days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (d = '{d:%Y-%m-%d}')")
    spark.sql(f"REFRESH TABLE {table}")
    return n


def apply_retention(spark: SparkSession, path: str, keep: int = schema.RETENTION_DAYS) -> list[dt.date]:
    """Remove the oldest days beyond ``keep`` (days from the folder listing)."""
    days = tables.listed_days(spark, path)
    return _drop_listed(spark, path, days[:max(len(days) - keep, 0)])


def excise_days(spark: SparkSession, path: str, first: str, last: str | None = None) -> int:
    """Remove the days ``first .. last`` from a day-partitioned table; returns how many held data."""
    lo = parse_day(first)
    hi = parse_day(last) if last is not None else lo
    if hi < lo:
        raise ValueError("last day before first day")
    return len(_drop_listed(spark, path, [d for d in tables.listed_days(spark, path) if lo <= d <= hi]))


def _drop_listed(spark: SparkSession, path: str, days: list[dt.date]) -> list[dt.date]:
    """Delete day folders and check that they are gone."""
    if days:
        drop_day_partitions(spark, path, days)
        spark.catalog.refreshByPath(path)
        left = set(days) & set(tables.listed_days(spark, path))
        if left:
            raise LifecycleError(f"days still in {path}: {sorted(left)}")
    return days


def path_is_complete(spark: SparkSession, path: str, day: dt.date) -> bool:
    """The build gate of a ``(d, h)`` table from its folders: all 24 hours hold data."""
    return len(tables.listed_hours(spark, path, day)) == 24


def path_needs_fill(spark: SparkSession, path: str, cap: int = schema.FILL_CAP_DAYS) -> bool:
    """Whether a table holds fewer days than the cap, from its folders (true for no table)."""
    return len(tables.listed_days(spark, path)) < cap


def partition_filter(keys: Sequence[str], values: Iterable[tuple]):
    """OR of equality terms on partition columns: static partition pruning."""
    cond = None
    for v in values:
        term = None
        for name, value in zip(keys, v):
            lit = date_literal(value) if isinstance(value, dt.date) else F.lit(value)
            t = F.col(name) == lit
            term = t if term is None else term & t
        cond = term if cond is None else cond | term
    return cond if cond is not None else F.lit(False)


def _counts(df: DataFrame, keys: Sequence[str]) -> dict[tuple, int]:
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()
    return {tuple(r[k] for k in keys): r["n"] for r in rows}


def contents(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per partition its rows and an order-free checksum of them: equal for equal sets of rows."""
    cols = sorted(c for c in df.columns if c not in keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("checksum"))


def reconcile(before: DataFrame, staged: DataFrame, keys: Sequence[str] = ("d", "h"),
              replace: bool = False) -> DataFrame:
    """What a publish of ``staged`` over ``before`` will do, per staged partition: ``before``, ``staged``
    and ``after`` counts, the ``action`` (write, replace, replay, refuse) and ``ok``.

    A partition that is present with the same rows is a replay and stays; one with other rows is
    refused, as its staged rows would be lost.
    """
    keys = list(keys)
    had = contents(before, keys).withColumnsRenamed({"n": "before", "checksum": "_b"})
    got = contents(staged, keys).withColumnsRenamed({"n": "staged", "checksum": "_s"})
    rows = got.join(had, keys, "left").withColumn("before", F.coalesce("before", F.lit(0).cast("bigint")))
    same = (F.col("before") == F.col("staged")) & F.col("_b").eqNullSafe(F.col("_s"))
    action = (F.when(F.col("before") == 0, F.lit("write")).when(F.lit(replace), F.lit("replace"))
              .when(same, F.lit("replay")).otherwise(F.lit("refuse")))
    return rows.select(*keys, "before", "staged", action.alias("action")).withColumns({
        "after": F.when(F.col("action").isin("write", "replace"), F.col("staged")).otherwise(F.col("before")),
        "ok": F.col("action") != "refuse"})


def row_difference(before: DataFrame, staged: DataFrame, keys: Sequence[str] = ("d", "h")) -> DataFrame:
    """The rows by which staged partitions differ from those present, as multisets (``EXCEPT ALL`` both ways).

    Every column of ``staged``, the ``side`` (``missing``: would be lost; ``added``) and ``n``, how many of the row.  Partitions
    with equal contents are left out by count and checksum first, so only those in dispute are shuffled; repeated rows are
    counted map-side, so a mass of equal rows is one row per task.
    """
    keys, cols = list(keys), staged.columns
    had = contents(before, keys).withColumnsRenamed({"n": "_n", "checksum": "_c"})
    same = (F.col("n") == F.col("_n")) & (F.col("checksum") == F.col("_c"))
    # one row per staged partition
    odd = contents(staged, keys).join(had, keys, "left").where(~F.coalesce(same, F.lit(False))).select(*keys)
    sides = (before.select(*cols, F.lit(-1).alias("_sign"))
             .unionByName(staged.select(*cols, F.lit(1).alias("_sign"))).join(odd, keys, "left_semi"))
    counted = sides.groupBy(*cols).agg(F.sum("_sign").alias("_d")).where("_d <> 0")
    return counted.select(*cols, F.when(F.col("_d") > 0, F.lit("added")).otherwise(F.lit("missing")).alias("side"),
                          F.abs("_d").alias("n"))


def publish(spark: SparkSession, staged: DataFrame, main_path: str,
            keys: Sequence[str] = ("d", "h"), cluster_partitions: int | None = None,
            replace: bool = False) -> list[dict]:
    """Move staged rows (read from files) into the main table and reconcile the counts.

    Refuses an empty stage.  A partition already in the main table must hold exactly the staged rows
    (a replay: nothing is done); with other rows the publish raises before it writes anything, as
    rows would be lost, unless ``replace`` asks to reload it (a corrected hour).  New partitions are
    written by dynamic partition overwrite, so a crashed and rerun publish gives the same table.
    Reads only the staged partition folders of the main table.  Returns, per staged partition:
    before, staged, after, action and ``ok`` (``after`` is counted after the write).
    """
    keys = list(keys)
    staged_counts = _counts(staged, keys)  # one row per staged partition
    if not staged_counts:
        raise LifecycleError("staged table is empty")
    main = tables.read_partitions(spark, main_path, keys, staged_counts)
    if main is None:
        plan = {k: {"before": 0, "staged": n, "action": "write"} for k, n in staged_counts.items()}
    else:
        plan = {tuple(r[k] for k in keys): r.asDict() for r in reconcile(main, staged, keys, replace).collect()}
    refused = [k for k, r in plan.items() if r["action"] == "refuse"]
    if refused:
        differ = row_difference(main, staged, keys).groupBy("side").agg(F.sum("n").alias("n")).collect()
        raise LifecycleError(f"present with other rows, staged rows would be lost: {sorted(refused)}; "
                             f"rows that differ: { {r['side']: r['n'] for r in differ} }")
    todo = [k for k, r in plan.items() if r["action"] in ("write", "replace")]
    after = {k: r["before"] for k, r in plan.items()}
    if todo:
        sort = tables.EVENT_SORT if keys[:2] == ["d", "h"] else tables.FUNNEL_SORT
        rows = staged if len(todo) == len(plan) else staged.where(partition_filter(keys, todo))
        tables.write_partitioned(rows, main_path, keys, [c for c in sort if c in staged.columns],
                                 cluster_partitions, scan=True)
        after.update(_counts(tables.read_partitions(spark, main_path, keys, todo), keys))
    out = []
    for k, r in sorted(plan.items()):
        expected = r["staged"] if k in todo else r["before"]
        out.append({**dict(zip(keys, k)), "before": r["before"], "staged": r["staged"], "after": after.get(k, 0),
                    "action": r["action"], "ok": after.get(k, 0) == expected})
    bad = [r for r in out if not r["ok"]]
    if bad:
        raise LifecycleError(f"count mismatch after publish: {bad}")
    return out
