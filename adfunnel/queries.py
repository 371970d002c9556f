"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through the fixture views) in full and
returns a DataFrame whose column names match ``oracle.SQL[key]``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions import clean, derive, urls
from .operators import funnel as fn
from .operators import membership, profile, sketches, slot_join, slots
from .plans import daily, ingest, lifecycle, repair
from .session import new_scratch_path
from .sources import fixtures as fx, ledger
from .sources import ssp as ssp_src
from .sources import ssp_history
from .sources import tables, tsv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return deco


def events_and_ssp(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.history_ref_view(spark, sf_dir), fx.ssp_view(spark, sf_dir)


@register("funnel_all")
def funnel_all(spark, sf_dir):
    h, ssp = events_and_ssp(spark, sf_dir)
    return fn.funnel(h, ssp, tiebreak=["event_id"])


@register("funnel_nonssp")
def funnel_nonssp(spark, sf_dir):
    h, ssp = events_and_ssp(spark, sf_dir)
    return fn.funnel(h, ssp, tiebreak=["event_id"], branch=False)


@register("funnel_ssp")
def funnel_ssp(spark, sf_dir):
    h, ssp = events_and_ssp(spark, sf_dir)
    return fn.funnel(h, ssp, tiebreak=["event_id"], branch=True)


# ---------------------------------------------------------------- funnel pieces

def branch_name():
    return F.when(F.col("is_ssp"), F.lit("ssp")).otherwise(F.lit("nonssp"))


@register("funnel_flags")
def funnel_flags(spark, sf_dir):
    """Read-time columns of the funnel table: dom, dotted IPs, presence flags."""
    rows = derive.with_funnel_aliases(funnel_all(spark, sf_dir))
    return rows.select("expid", "d", "sec", "tn", "dom", "ip_bid", "ip_exp", "ip_cl",
                       "has_bid", "has_exp", "has_cl")


@register("slot_assignment")
def slot_assignment(spark, sf_dir):
    """Every (event, slot) pair the funnel groups: one or two slots per event."""
    h, ssp = events_and_ssp(spark, sf_dir)
    rows = slots.assign_slots(fn.branch_rows(h, ssp))
    return rows.select("event_id", branch_name().alias("branch"), F.col("slot_d").alias("d"), "slot")


@register("slot_assignment_table")
def slot_assignment_table(spark, sf_dir):
    """``slot_assignment`` with the slots as a table."""
    h, ssp = events_and_ssp(spark, sf_dir)
    rows = slot_join.assign_slots(fn.branch_rows(h, ssp), slot_join.standard_slots(spark))
    return rows.select("event_id", branch_name().alias("branch"), F.col("slot_d").alias("d"), "slot")


def many_slots(spark) -> DataFrame:
    """500 overlapping slots of ten minutes to over two hours for both branches and every role."""
    lo = F.col("slot") * 173
    return (spark.range(500).select(F.col("id").cast("int").alias("slot"))
            .withColumn("is_ssp", F.explode(F.array(F.lit(False), F.lit(True))))
            .withColumn("role", F.explode(F.array(*map(F.lit, (slots.ANCHOR, slots.EXPOSURE, slots.CLICK)))))
            .select("is_ssp", "role", "slot", lo.cast("bigint").alias("lo"),
                    (lo + 600 + (F.col("slot") * 37) % 7200 + F.col("role") * 60).cast("bigint").alias("hi")))


@register("slot_assignment_many")
def slot_assignment_many(spark, sf_dir):
    """Events per day, branch and slot of a table of 500 slots."""
    h, ssp = events_and_ssp(spark, sf_dir)
    rows = slot_join.assign_slots(fn.branch_rows(h, ssp), many_slots(spark))
    return rows.groupBy(F.col("slot_d").alias("d"), branch_name().alias("branch"), "slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register("union_branches")
def union_branches(spark, sf_dir):
    """Inputs of both branches in one scan; click rows carry no ref / bref."""
    h, ssp = events_and_ssp(spark, sf_dir)
    rows = fn.branch_rows(h, ssp)
    blank = F.col("tn") == schema.TN_CLICK
    return rows.select("event_id", branch_name().alias("branch"), "tn",
                       F.when(blank, F.lit("")).otherwise(F.col("ref")).alias("ref"),
                       F.when(blank, F.lit("")).otherwise(F.col("bref")).alias("bref"))


@register("valid_events")
def valid_events(spark, sf_dir):
    h = fx.history_ref_view(spark, sf_dir)
    return fn.valid_events(h).select("event_id", "expid", "tn", "sec", "sid")


@register("first_by_type")
def first_by_type(spark, sf_dir):
    """Per exposure: time and user of its first bid, impression and click (defaults 0 / epoch)."""
    h = fx.history_ref_view(spark, sf_dir)
    rows = h.where((F.col("sn") == schema.SN_OK) & (F.col("expid") != 0)
                   & F.col("tn").isin(schema.TN_BID, schema.TN_IMPRESSION, schema.TN_CLICK))
    names = {schema.TN_BID: "bid", schema.TN_IMPRESSION: "exp", schema.TN_CLICK: "cl"}
    g = rows.groupBy("expid").agg(*[
        F.min(F.when(F.col("tn") == tn, F.struct("sec", "event_id", "uid"))).alias(n)
        for tn, n in names.items()])
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    cols = ["expid"]
    for n in names.values():
        cols += [F.coalesce(F.col(f"{n}.sec"), epoch).alias(f"first_sec_{n}"),
                 F.coalesce(F.col(f"{n}.uid"), F.lit(0).cast("bigint")).alias(f"first_uid_{n}")]
    return g.select(*cols)


# ---------------------------------------------------------------- cleaning and derived columns


def raw_with_nulls(spark, sf_dir):
    """The event view with values knocked out, as a raw feed would miss them."""
    h = fx.history_ref_view(spark, sf_dir)
    err = F.col("sn") == 1
    low = F.col("geo") < 20
    knocked = {"sid": err, "sz": err, "ref": err, "geo": low, "ipint": low, "bt": low,
               "custom": low, "expid": err & low, "exppr": low, "stn": err}
    return h.select("event_id", *[
        F.when(knocked[c], F.lit(None).cast(schema.EVENT_TYPES[c])).otherwise(F.col(c)).alias(c)
        if c in knocked else F.col(c) for c in schema.EVENT_COLUMNS])


@register("null_defaults")
def null_defaults(spark, sf_dir):
    return clean.fill_defaults(raw_with_nulls(spark, sf_dir))


@register("strip_breaking_chars")
def strip_breaking_chars(spark, sf_dir):
    """Whole documents stripped of tab-breaking characters: length, digest, removed count."""
    docs = fx.read_table(spark, sf_dir, "documents")
    stripped = clean.strip_breaking(F.col("text"))
    return docs.select(
        "doc_id",
        F.length(stripped).cast("bigint").alias("clean_len"),
        F.md5(stripped).alias("clean_md5"),
        (F.length("text") - F.length(stripped)).cast("bigint").alias("n_removed"))


def repair_inputs(spark, sf_dir):
    """Refs of the two scheme-less sites, derived from page URLs.

    By page id: sid 197671 / 187537 / other; the ref as is, without scheme,
    with a ``.google`` suffix (scheme kept), or empty.
    """
    pages = fx.read_table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    sid = (F.when(pid % 3 == 0, F.lit(clean.SCHEMELESS_SITE))
           .when(pid % 3 == 1, F.lit(clean.GOOGLE_SITE)).otherwise(pid)).cast("bigint")
    bare = F.regexp_replace("url", "^[a-zA-Z]+://", "")
    ref = (F.when(pid % 4 == 0, F.col("url")).when(pid % 4 == 1, bare)
           .when(pid % 4 == 2, F.concat(F.col("url"), F.lit(clean.GOOGLE_SUFFIX)))
           .otherwise(F.lit("")))
    return pages.select("page_id", sid.alias("sid"), ref.alias("ref_in"))


@register("scheme_repair")
def scheme_repair(spark, sf_dir):
    rows = repair_inputs(spark, sf_dir)
    return rows.withColumn("ref_out", clean.repair_scheme(F.col("ref_in"), F.col("sid")))


@register("url_domain")
def url_domain(spark, sf_dir):
    pages = fx.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", urls.domain_without_www(F.col("url")).alias("dom"))


@register("url_fingerprint")
def url_fingerprint(spark, sf_dir):
    pages = fx.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.url_fingerprint(F.col("url")).alias("refhash"))


@register("ipv4_text")
def ipv4_text(spark, sf_dir):
    h = fx.history_ref_view(spark, sf_dir)
    return h.select("event_id", "ipint", derive.ipv4_text(F.col("ipint")).alias("ip"))


@register("event_enriched")
def event_enriched(spark, sf_dir):
    """The event table as stored (22 columns + dom, refhash, d, h) with the ip alias."""
    h = fx.history_ref_view(spark, sf_dir)
    return derive.with_event_aliases(tables.event_table_frame(h, keep=["event_id"]))


@register("user_group_filter")
def user_group_filter(spark, sf_dir):
    lo, hi = schema.SHARD_GROUPS[1]
    h = fx.history_ref_view(spark, sf_dir)
    return (h.where(derive.in_user_groups(F.col("uid"), lo, hi))
            .select("event_id", "uid", derive.user_group(F.col("uid")).alias("ug")))


SLICE_HOUR = dt.datetime(2024, 1, 5, 13)


@register("ingest_hour_slice")
def ingest_hour_slice(spark, sf_dir):
    """The hourly ingest of one hour for the first shard's user groups."""
    lo, hi = schema.SHARD_GROUPS[1]
    # truncation to seconds moves no time over a whole hour: the bounds hold for ``ts`` and reach the scan
    h = fx.history_ref_view(spark, sf_dir, derive.in_hour(F.col("ts"), SLICE_HOUR))
    return ingest.ingest_hour(h, SLICE_HOUR, lo, hi, keep=["event_id"])


@register("window_end")
def window_end(spark, sf_dir):
    """Distinct hour starts of the events and their 4 h 5 min window ends."""
    h = fx.history_ref_view(spark, sf_dir)
    start = F.make_timestamp_ntz(F.year("sec"), F.month("sec"), F.dayofmonth("sec"),
                                 F.hour("sec"), F.lit(0), F.lit(0))
    return (h.select(start.alias("s")).distinct()
            .select(derive.format_window(F.col("s")).alias("window_start"),
                    derive.format_window(derive.window_end(F.col("s"), 4, 5)).alias("window_end")))


@register("sample_by_user")
def sample_by_user(spark, sf_dir):
    h = fx.history_ref_view(spark, sf_dir)
    return h.where(derive.user_sample(F.col("uid"), 10, 3)).select("event_id", "uid")


@register("hour_key_from_path")
def hour_key_from_path(spark, sf_dir):
    """Hour file paths of the events and the hour read back from them."""
    h = fx.history_ref_view(spark, sf_dir)
    path = F.concat(F.lit("../../reg_history_ref/"), F.date_format("sec", "yyyy-MM-dd"),
                    F.lit("/"), F.date_format("sec", "HH"), F.lit("_s1.txt"))
    return (h.select(path.alias("path")).distinct()
            .select("path", tsv.hour_key(F.col("path")).alias("src_hour")))


# ---------------------------------------------------------------- profiles and membership


@register("volume_by_site_nonssp")
def volume_by_site_nonssp(spark, sf_dir):
    h, ssp = events_and_ssp(spark, sf_dir)
    return profile.volume_by_site(h, ssp)


@register("volume_by_site_zone_ssp")
def volume_by_site_zone_ssp(spark, sf_dir):
    h, ssp = events_and_ssp(spark, sf_dir)
    return profile.volume_by_site_zone(h, ssp)


TRACED = (7, 50, 123, 200)


@register("exposure_trace")
def exposure_trace(spark, sf_dir):
    """All events of four exposures, whatever their type and status."""
    return tables.trace(fx.history_ref_view(spark, sf_dir), TRACED).select("expid", "sec", "event_id", "tn", "sn", "uid", "sid", "ref")


@register("uniq_users")
def uniq_users(spark, sf_dir):
    """Users per site over all days: from merged hourly sketches, beside the exact count; whether they agree within 5%."""
    h = fx.history_ref_view(spark, sf_dir)
    about = sketches.uniq(sketches.hourly(h), ["sid"])
    exact = h.groupBy("sid").agg(F.count_distinct("uid").alias("users"))
    near = F.abs(F.col("uniq") - F.col("users")) <= F.greatest(F.lit(2.0), 0.05 * F.col("users"))
    return about.join(exact, "sid").select("sid", "n", "users", near.alias("uniq_within_5_percent"))


@register("volume_by_site_asof")
def volume_by_site_asof(spark, sf_dir):
    """Rows per day and site, with the branch of the site by the SSP list that was valid on the day."""
    dated = ssp_history.validity(fx.ssp_versions_view(spark, sf_dir), forget=True)
    return profile.volume_by_site_asof(fx.history_ref_view(spark, sf_dir), dated)


@register("funnel_asof")
def funnel_asof(spark, sf_dir):
    """The funnel of all days, each by the SSP list that was valid on it."""
    dated = ssp_history.validity(fx.ssp_versions_view(spark, sf_dir), forget=True)
    return fn.funnel(fx.history_ref_view(spark, sf_dir), dated, tiebreak=["event_id"])


@register("ssp_validity")
def ssp_validity(spark, sf_dir):
    """From when to when each site was on the SSP list, if sites can leave it and if they cannot."""
    versions = fx.ssp_versions_view(spark, sf_dir)
    both = [ssp_history.validity(versions, forget).withColumn("forget", F.lit(forget)) for forget in (False, True)]
    return both[0].unionByName(both[1])


SUBSET_SITES = (3, 7, 12)
SUBSET_PAIRS = ((3, (1, 2)), (7, None), (12, (0, 5)))


@register("site_subset")
def site_subset(spark, sf_dir):
    h = fx.history_ref_view(spark, sf_dir)
    return (membership.sites_in(h, SUBSET_SITES)
            .groupBy("sid").agg(F.count(F.lit(1)).alias("n")))


@register("site_zone_subset")
def site_zone_subset(spark, sf_dir):
    h = fx.history_ref_view(spark, sf_dir)
    return (membership.site_zones_in(h, spark, SUBSET_PAIRS)
            .groupBy("sid", "sz").agg(F.count(F.lit(1)).alias("n")))


@register("day_completeness")
def day_completeness(spark, sf_dir):
    return lifecycle.completeness(fx.history_ref_view(spark, sf_dir))


@register("distinct_days")
def distinct_days(spark, sf_dir):
    return profile.distinct_days(fx.history_ref_view(spark, sf_dir))


# ---------------------------------------------------------------- lifecycle


def ssp_bids(spark, sf_dir):
    """Valid bids of SSP sites: a sparse stream, so some hours hold none."""
    h, ssp = events_and_ssp(spark, sf_dir)
    bids = fn.valid_events(h).where(F.col("tn") == schema.TN_BID)
    return membership.only_ssp(bids, ssp)


@register("hour_present")
def hour_present(spark, sf_dir):
    days = profile.distinct_days(fx.history_ref_view(spark, sf_dir))
    return lifecycle.hours_present(ssp_bids(spark, sf_dir), days)


@register("missing_hours")
def missing_hours(spark, sf_dir):
    days = profile.distinct_days(fx.history_ref_view(spark, sf_dir))
    return lifecycle.missing_hours(ssp_bids(spark, sf_dir), days)


EXCISE_FIRST, EXCISE_LAST = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
BACKFILL_TODAY = dt.date(2024, 1, 20)


@register("missing_days")
def missing_days(spark, sf_dir):
    """Backfill list of 2024-01-20 against the events with 10-12 January cut out."""
    table = lifecycle.outside_days(fx.history_ref_view(spark, sf_dir), EXCISE_FIRST, EXCISE_LAST)
    return lifecycle.missing_days(table, lifecycle.day_list(spark, BACKFILL_TODAY))


@register("need_fill")
def need_fill(spark, sf_dir):
    return lifecycle.fill_state(fx.history_ref_view(spark, sf_dir))


@register("retention_expired_days")
def retention_expired_days(spark, sf_dir):
    return lifecycle.expired_days(fx.history_ref_view(spark, sf_dir))


@register("retention_keep")
def retention_keep(spark, sf_dir):
    return lifecycle.kept_day_counts(fx.history_ref_view(spark, sf_dir))


@register("excise_days")
def excise_days(spark, sf_dir):
    rest = lifecycle.outside_days(fx.history_ref_view(spark, sf_dir), EXCISE_FIRST, EXCISE_LAST)
    return rest.groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@register("shard_union")
def shard_union(spark, sf_dir):
    """The events split into the two shards' user groups and read back as one table."""
    h = fx.history_ref_view(spark, sf_dir)
    shards = [h.where(derive.in_user_groups(F.col("uid"), lo, hi)).withColumn("shard", F.lit(s))
              for s, (lo, hi) in schema.SHARD_GROUPS.items()]
    whole = tables.union_shards(shards)
    return (whole.groupBy(derive.user_group(F.col("uid")).alias("ug"), "shard")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("sum_event_id")))


SSP_LOAD_DATE = dt.date(2024, 1, 31)


def ssp_text_lines(spark, sf_dir):
    """The SSP list rendered as ``sid<tabs>name`` text: runs of 1-3 tabs, plus
    lines of other nations with a non-numeric id (rejected)."""
    nation = fx.read_table(spark, sf_dir, "nation")
    tabs = F.expr("repeat('\\t', 1 + n_nationkey % 3)")
    good = F.concat(F.col("n_nationkey").cast("string"), tabs, F.col("n_name"))
    bad = F.concat(F.lit("x"), F.col("n_nationkey").cast("string"), tabs, F.col("n_name"))
    return nation.select(F.when(F.col("n_regionkey").isin(*fx.SSP_REGIONS), good)
                         .otherwise(bad).alias("value"))


@register("ssp_sites_load")
def ssp_sites_load(spark, sf_dir):
    sites, _ = ssp_src.parse_lines(ssp_text_lines(spark, sf_dir), SSP_LOAD_DATE)
    return sites


PUBLISH_DAY = dt.date(2024, 1, 10)


@register("publish_reconcile")
def publish_reconcile(spark, sf_dir):
    """What publishing one staged day does, per (d, h), to a table that lacks some of its hours, holds
    some with the same rows (a replay) and some with fewer (refused, or replaced when told to)."""
    table = tables.event_table_frame(fx.history_ref_view(spark, sf_dir), keep=["event_id"])
    staged = table.where(F.col("d") == derive.date_literal(PUBLISH_DAY))
    held = staged.where((F.col("h") % 3 != 0) & ((F.col("h") % 3 != 1) | (F.col("event_id") % 2 == 0)))
    plain = lifecycle.reconcile(held, staged).withColumn("replace", F.lit(False))
    told = lifecycle.reconcile(held, staged, replace=True).withColumn("replace", F.lit(True))
    return plain.unionByName(told)


def hour_lines(spark, sf_dir):
    """The events as lines of their hour files, with what goes wrong in a feed: by event_id, a user id
    of 2^63 and more (% 11 = 0), a line cut short (% 13 = 0), no user (% 17 = 0), a type code out of range
    (% 19 = 0) and a time in the next hour's file (% 23 = 0)."""
    h = fx.history_ref_view(spark, sf_dir)
    eid = F.col("event_id")
    uid = F.when(eid % 11 == 0, F.col("uid") + F.lit(-2 ** 63)).otherwise(F.col("uid"))
    start = F.make_timestamp_ntz(F.year("sec"), F.month("sec"), F.dayofmonth("sec"), F.hour("sec"),
                                 F.lit(0), F.lit(0))
    shown = h.withColumn("uid", uid).select("event_id", start.alias("start"), tsv.line_of().alias("line"))
    fields = F.split("line", "\t", -1)
    line = (F.when(eid % 13 == 0, F.array_join(F.slice(fields, 1, 5), "\t"))
            .when(eid % 17 == 0, F.concat_ws("\t", F.lit(""), F.array_join(F.slice(fields, 2, 21), "\t")))
            .when(eid % 19 == 0, F.concat_ws("\t", F.array_join(F.slice(fields, 1, 3), "\t"), F.lit("300"),
                                             F.array_join(F.slice(fields, 5, 18), "\t")))
            .otherwise(F.col("line")))
    late = F.when(eid % 23 == 0, F.col("start") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("start"))
    return shown.select("event_id", line.alias("value"), late.alias("src_hour"))


@register("load_accounting")
def load_accounting(spark, sf_dir):
    """Per hour file: lines, and the rows of each class of the first shard's load."""
    lo, hi = schema.SHARD_GROUPS[1]
    rows = ingest.flagged_lines(hour_lines(spark, sf_dir))
    kind = ingest.row_class(F.col("src_hour"), lo, hi, F.col("_bad"))
    return rows.select("src_hour", kind.alias("class")).groupBy("src_hour").agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count(F.when(F.col("class") == c, 1)).alias(c) for c in ingest.CLASSES])


def delivered(h: DataFrame) -> DataFrame:
    """The events as landed files, three parts an hour, and each first part once more under another name."""
    k = (F.col("event_id") % 3).cast("string")
    stem = F.concat(F.lit("/in/"), F.date_format("sec", "yyyy-MM-dd/HH"), F.lit("_p"), k)
    names = F.when(k == "0", F.array(F.lit(".txt"), F.lit("_again.txt"))).otherwise(F.array(F.lit(".txt")))
    lines = h.select("event_id", "sec", tsv.line_of().alias("value"), stem.alias("stem"), F.explode(names).alias("name"),
                     F.date_trunc("hour", "sec").cast("timestamp_ntz").alias("src_hour"))
    return lines.select("event_id", "sec", "value", F.concat("stem", "name").alias("file"), "src_hour")


@register("load_in_parts")
def load_in_parts(spark, sf_dir):
    """Every landed file, its lines and what a load does with it: the ledger holds the files of every third day,
    of the second parts with the even events alone."""
    lines = delivered(fx.history_ref_view(spark, sf_dir))
    second = F.col("file").endswith("_p1.txt")
    then = lines.where((F.dayofmonth("sec") % 3 == 0) & ~F.col("file").endswith("_again.txt")
                       & (~second | (F.col("event_id") % 2 == 0)))
    known = ledger.described(then).withColumn("state", F.lit(ledger.LOADED))
    return ledger.judged(ledger.described(lines), known).select("path", "src_hour", "lines", "state")


@register("reconcile_diff")
def reconcile_diff(spark, sf_dir):
    """Which rows a staged copy of the events lacks, has too many of or has changed."""
    h = fx.history_ref_view(spark, sf_dir).select("event_id", "uid", "sec", "geo", "sid", F.to_date("sec").alias("d"))
    e, first = F.col("event_id"), F.dayofmonth("sec") <= 20
    times = F.when(first & (e % 11 == 0), 0).when(first & (e % 13 == 0), 3).otherwise(1)
    staged = (h.withColumn("geo", F.when(first & (e % 17 == 0), F.col("geo") + 1).otherwise(F.col("geo")))
              .withColumn("_i", F.explode(F.array_repeat(F.lit(1), times))).drop("_i"))
    return lifecycle.row_difference(h, staged, ["d"]).select("event_id", "geo", "d", "side", "n")


@register("tsv_round_trip")
def tsv_round_trip(spark, sf_dir):
    """The events with blanks at the ends of values, carriage returns and ids of 2^63 and more, rendered as
    lines and parsed again."""
    h = fx.history_ref_view(spark, sf_dir)
    big = F.when(F.col("event_id") % 2 == 0, F.lit(-2 ** 63)).otherwise(F.lit(0))
    odd = h.withColumns({"uid": F.col("uid") + big, "sid": F.col("sid") + big,
                         "ref": F.concat(F.lit(" "), "ref", F.lit(" ")),
                         "bref": F.concat("bref", F.lit("\r")), "custom": F.lit("a\rb ")})
    lines = odd.select("event_id", tsv.line_of().alias("value"))
    back = tsv.parse_flagged(tsv.split_lines(lines, keep=["event_id", "value"]), keep=["event_id", "value"])
    return back.select("event_id", F.md5("value").alias("line_md5"), tsv.unsigned_text(F.col("uid")).alias("uid_text"),
                       F.col("_bad").alias("rejected"),
                       *[c for c in schema.EVENT_COLUMNS])


@register("tsv_rejects")
def tsv_rejects(spark, sf_dir):
    """Which lines of the faulty feed do not parse, and those lines."""
    lines = hour_lines(spark, sf_dir)
    rows = tsv.parse_flagged(tsv.split_lines(lines, keep=["event_id", "value"]), keep=["event_id", "value"])
    return rows.select("event_id", F.col("_bad").alias("rejected"), F.when(F.col("_bad"), F.col("value")).alias("value"))


FUNNEL_DAY = dt.date(2024, 1, 5)


@register("funnel_day")
def funnel_day(spark, sf_dir):
    """The production daily build: one day's funnel from that day and the first two hours of the next."""
    h, ssp = events_and_ssp(spark, sf_dir)
    return daily.funnel_for_day(h, ssp, FUNNEL_DAY, tiebreak=["event_id"])


@register("publish_day")
def publish_day(spark, sf_dir):
    """A day's events staged, published by hour, published again (a replay), and read back: per hour what each publish
    did and what the table holds."""
    day = fx.history_ref_view(spark, sf_dir).where(F.to_date("sec") == F.lit(FUNNEL_DAY))
    rows = tables.event_table_frame(day, keep=["event_id"])
    stage, main = (new_scratch_path(spark, x) for x in ("publish-stage", "publish-main"))
    rows.write.parquet(stage)
    staged = spark.read.schema(rows.schema).parquet(stage)
    # 24 rows each
    done = [(i, r["h"], r["before"], r["staged"], r["after"], r["action"]) for i in (1, 2)
            for r in lifecycle.publish(spark, staged, main)]
    tables.delete_path(spark, stage)
    report = spark.createDataFrame(done, "run int, h int, before bigint, staged bigint, after bigint, action string")
    held = spark.read.parquet(main).groupBy("h").agg(F.count(F.lit(1)).alias("held"), F.sum("event_id").alias("ids"))
    return report.join(held, "h", "left")


@register("backfill_days")
def backfill_days(spark, sf_dir):
    """Two runs of the backfill over two days whose events land day by day: what each run built, the events of the day and the rows of the
    funnel table by day after it.  The second run finds all days up to date."""
    h, ssp = events_and_ssp(spark, sf_dir)
    events, out = (new_scratch_path(spark, x) for x in ("backfill-events", "backfill-funnel"))
    loaded = set()

    def load_day(day):
        if day not in loaded:  # as the loads do: an hour that is present is skipped
            loaded.add(day)
            tables.write_events(h.where(F.to_date("sec") == F.lit(day)), events)

    done = []
    for run in (1, 2):
        built = daily.backfill(spark, FUNNEL_DAY + dt.timedelta(days=2), load_day, events, out, ssp, days=2, repair_late=run == 1)
        days = {d: [] for d in tables.listed_days(spark, out)}
        for d, what in built:
            days.setdefault(d, []).append(what)
        done += [(run, d, ",".join(days[d])) for d in days]
    report = spark.createDataFrame(done, "run int, d date, done string")
    funnel = spark.read.schema(schema.FUNNEL_SCHEMA).parquet(out) if tables.has_data(spark, out) \
        else spark.createDataFrame([], schema.FUNNEL_SCHEMA)
    events_of = profile.with_day(h).groupBy("d").agg(F.count(F.lit(1)).alias("events"))
    return (report.join(funnel.groupBy("d").agg(F.count(F.lit(1)).alias("rows")), "d", "left")
            .join(events_of, "d", "left"))


def late_event():
    """Rows of ``events`` that the first build of ``funnel_repair`` has not seen: two hours of each day
    (one of them is read by two days' builds) and every ninth event beside."""
    return F.hour("ts").isin(1, 13) | (F.col("event_id") % 9 == 0)


@register("funnel_repair")
def funnel_repair(spark, sf_dir):
    """The funnel of all days, from one built without the late events and repaired by their groups."""
    h, ssp = events_and_ssp(spark, sf_dir)
    old = fn.funnel(fx.history_ref_view(spark, sf_dir, ~late_event()), ssp, tiebreak=["event_id"])
    groups = repair.changed_groups(fx.history_ref_view(spark, sf_dir, late_event()), ssp)
    return repair.repaired(old, h, groups, ssp, tiebreak=["event_id"])


@register("day_membership")
def day_membership(spark, sf_dir):
    """Events that the build of one day reads."""
    h = fx.history_ref_view(spark, sf_dir)
    return daily.day_scope(h, FUNNEL_DAY).select("event_id", "sec")
