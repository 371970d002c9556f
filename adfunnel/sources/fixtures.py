"""Driver test tables seen as event and dimension tables.

``history_ref_view`` maps the generic ``events`` table onto the 22-column event
layout (FIXTURES.md section 3).  Four neighbouring events share an exposure id,
so bids, impressions and clicks meet in funnels at every scale, and ``sid`` /
``sz`` are constant per exposure.  ``ssp_view`` takes the nations of regions 0
and 1 as the supply-side-platform site list.

Both views are plain DataFrame plans over the parquet files, so a query built
on them scans the whole tables and prunes columns like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators.membership import bounded_broadcast

# Fixed values of the fixture mapping (FIXTURES.md section 3).
INVALID_EXPID_MODULUS = 97     # expid = 0 when event_id % 97 = 0
SITE_MODULUS = 25              # sid = (event_id div 4 + 1) % 25
ZONE_MODULUS = 7               # sz  = (event_id div 4 + 1) % 7
BANNER_MODULUS = 5             # bt  = event_id % 5
IP_BASE = 3232235520           # ipint = 3232235520 + user_id (192.168.0.0)
EVENT_TYPE_TN = {"view": 0, "click": 1, "purchase": 2, "signup": 3, "error": 0}
SSP_REGIONS = (0, 1)

# Pages above this number are joined by a shuffle; a url of 200 bytes makes 200 MB of broadcast.
PAGES_BROADCAST_ROWS = 1_000_000


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Reuse a DataFrame *definition* per session: the driver tables are
    read-only, so the plan (schema, file listing, analysed view) is built once.
    No data is cached; every action still scans the files."""
    plans = spark.__dict__.setdefault("_adfunnel_plans", {})  # goes when the session goes
    if key not in plans:
        plans[key] = build()
    return plans[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _memo(spark, ("table", path), lambda: spark.read.parquet(path))


def whole_seconds(ts: Column) -> Column:
    """Truncate a timestamp_ntz to the second without leaving the NTZ type."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.minute(ts), F.second(ts))


def _page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One url per page id, broadcast if ``pages`` is small enough (checked)."""
    pages = read_table(spark, sf_dir, "pages")
    rows = pages.groupBy("page_id").agg(F.min("url").alias("url"))
    return bounded_broadcast(rows, page_count(spark, sf_dir), PAGES_BROADCAST_ROWS)


def page_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows of ``pages`` (from the file footers), once per session."""
    return _memo(spark, ("pages", sf_dir.rstrip("/")), lambda: read_table(spark, sf_dir, "pages").count())


def history_ref_view(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """``events`` as the event table: ``event_id`` plus the 22 stored columns.

    ``where``: a filter on the columns of ``events``, pushed to its scan.
    """
    if where is not None:
        return _history_ref_view(spark, sf_dir, where)
    return _memo(spark, ("H", sf_dir.rstrip("/")), lambda: _history_ref_view(spark, sf_dir))


def _history_ref_view(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.where(where)
    urls = _page_urls(spark, sf_dir)
    n_pages = max(page_count(spark, sf_dir), 1)
    exposure = F.expr("event_id div 4") + 1
    tn = F.col("event_type")
    tn_code = F.lit(0)
    for name, code in EVENT_TYPE_TN.items():
        tn_code = F.when(tn == name, F.lit(code)).otherwise(tn_code)
    base = ev.select(
        F.col("event_id"),
        F.col("user_id").alias("uid"),
        whole_seconds(F.col("ts")).alias("sec"),
        F.when(F.col("event_id") % INVALID_EXPID_MODULUS == 0, F.lit(0)).otherwise(exposure)
        .cast("bigint").alias("expid"),
        tn_code.cast("tinyint").alias("tn"),
        F.when(tn == "error", F.lit(1)).otherwise(F.lit(0)).cast("tinyint").alias("sn"),
        F.lit(0).cast("tinyint").alias("stn"),
        (F.col("event_id") % n_pages).alias("_ref_page"),
        (exposure % SITE_MODULUS).cast("bigint").alias("sid"),
        (exposure % ZONE_MODULUS).cast("bigint").alias("sz"),
        ((F.col("event_id") + 1) % n_pages).alias("_bref_page"),
        F.get_json_object("props", "$.k").cast("int").alias("geo"),
        (F.lit(IP_BASE) + F.col("user_id")).cast("bigint").alias("ipint"),
        F.lit(0).cast("int").alias("pz"),
        (F.col("event_id") % BANNER_MODULUS).cast("int").alias("bt"),
        F.lit(0).cast("bigint").alias("ad"),
        F.lit(0).cast("bigint").alias("net"),
        F.lit(0.0).alias("exppr"),
        F.lit(0.0).alias("winexppr"),
        F.lit(0.0).alias("secondpr"),
        F.lit(0.0).alias("floor"),
        F.lit(0).cast("bigint").alias("ddid"),
        F.lit("").alias("custom"),
    )
    ref = urls.select(F.col("page_id").alias("_ref_page"), F.col("url").alias("ref"))
    bref = urls.select(F.col("page_id").alias("_bref_page"), F.col("url").alias("bref"))
    joined = base.join(ref, "_ref_page", "left").join(bref, "_bref_page", "left")
    return joined.select("event_id", *[
        F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("ref", "bref") else F.col(c)
        for c in schema.EVENT_COLUMNS
    ])


def ssp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SSP site list: nations of regions 0 and 1 (sid = nation key)."""
    return _memo(spark, ("ssp", sf_dir.rstrip("/")), lambda: _ssp_view(spark, sf_dir))


def _ssp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return (nation.where(F.col("n_regionkey").isin(*SSP_REGIONS))
            .select(F.col("n_nationkey").cast("bigint").alias("sid"),
                    F.col("n_name").alias("name")))


# Fixed values of the dated list: which regions' nations each version names.
SSP_VERSIONS = (("2024-01-03", (0,)), ("2024-01-10", (0, 1)), ("2024-01-20", (1, 2)))


def ssp_versions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions ``(sid, name, d)`` of the SSP list: nations of other regions at each date."""
    nation = read_table(spark, sf_dir, "nation")
    spans = F.array(*[F.struct(F.lit(d).cast("date").alias("d"), F.array(*map(F.lit, regions)).alias("regions"))
                      for d, regions in SSP_VERSIONS])
    rows = nation.withColumn("v", F.explode(spans)).where(F.array_contains("v.regions", F.col("n_regionkey")))
    return rows.select(F.col("n_nationkey").cast("bigint").alias("sid"), F.col("n_name").alias("name"), "v.d")
