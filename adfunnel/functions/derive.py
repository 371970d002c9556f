"""Derived columns: IPv4 text, date / hour, presence flags, window end,
user groups, hour windows and deterministic user sampling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from . import urls


def ipv4_text(ip: Column) -> Column:
    """Unsigned 32-bit integer -> dotted quad."""
    octets = [F.shiftright(ip, s).bitwiseAND(255).cast("string") for s in (24, 16, 8)]
    return F.concat_ws(".", *octets, ip.bitwiseAND(255).cast("string"))


def ipv4_text_or_empty(ip: Column) -> Column:
    """As ``ipv4_text`` but 0 (no such event) gives ''."""
    return F.when(ip == 0, F.lit("")).otherwise(ipv4_text(ip))


def present(ip: Column) -> Column:
    """1 if the event took place (its IP is non-zero), else 0."""
    return F.when(ip != 0, F.lit(1)).otherwise(F.lit(0)).cast("tinyint")


def event_date(sec: Column) -> Column:
    return F.to_date(sec)


def event_hour(sec: Column) -> Column:
    return F.hour(sec)


def with_event_columns(df: DataFrame) -> DataFrame:
    """Stored derived columns of the event table: dom, refhash, d, h."""
    return (df.withColumn("dom", urls.domain_without_www(F.col("ref")))
            .withColumn("refhash", urls.url_fingerprint(F.col("ref")))
            .withColumn("d", event_date(F.col("sec")))
            .withColumn("h", event_hour(F.col("sec"))))


def with_event_aliases(df: DataFrame) -> DataFrame:
    """Read-time column of the event table: ip."""
    return df.withColumn("ip", ipv4_text(F.col("ipint")))


def with_funnel_aliases(df: DataFrame) -> DataFrame:
    """Read-time columns of the funnel table: dom, ip_*, has_*."""
    out = df.withColumn("dom", urls.domain_without_www(F.col("ref")))
    for kind in ("bid", "exp", "cl"):
        ip = F.col(f"ipint_{kind}")
        out = out.withColumn(f"ip_{kind}", ipv4_text_or_empty(ip)).withColumn(f"has_{kind}", present(ip))
    return out


WINDOW_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def window_end(start: Column, hours: int, minutes: int = 0) -> Column:
    """start + hours + minutes - 1 second (inclusive end of a window)."""
    return start + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes), F.lit(-1))


def format_window(ts: Column) -> Column:
    return F.date_format(ts, WINDOW_FORMAT)


def user_group(uid: Column) -> Column:
    """User group 1..256 of a user id."""
    return F.pmod(uid, F.lit(schema.USER_GROUPS)) + 1


def check_groups(ug_from: int, ug_to: int) -> None:
    if ug_from < 1 or ug_to < 1 or ug_from > ug_to:
        raise ValueError(f"bad user groups: {ug_from} {ug_to}")


def in_user_groups(uid: Column, ug_from: int, ug_to: int) -> Column:
    check_groups(ug_from, ug_to)
    return user_group(uid).between(ug_from, ug_to)


def ntz_literal(value: dt.datetime) -> Column:
    """A timestamp_ntz literal (no time zone involved, unlike ``lit(datetime)``)."""
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S}'")


def date_literal(value: dt.date) -> Column:
    return F.expr(f"DATE '{value:%Y-%m-%d}'")


def in_hour(sec: Column, hour: dt.datetime) -> Column:
    """``hour <= sec < hour + 1h`` on whole-second timestamps (upper bound open)."""
    start = hour.replace(minute=0, second=0, microsecond=0)
    end = start + dt.timedelta(hours=1)
    return (sec >= ntz_literal(start)) & (sec < ntz_literal(end))


def hour_partition(hour: dt.datetime) -> Column:
    """Partition predicate of one hour on a table partitioned by (d, h)."""
    return (F.col("d") == date_literal(hour.date())) & (F.col("h") == F.lit(hour.hour))


def user_sample(uid: Column, buckets: int, bucket: int) -> Column:
    """Deterministic sample by user: bucket ``bucket`` of ``buckets``.

    Every event of a user lands in the same bucket, so a sampled query keeps
    whole users (funnels stay intact).
    """
    if not 0 <= bucket < buckets:
        raise ValueError("bucket must lie in [0, buckets)")
    # ids of 2^63 and more are stored minus 2^64
    wrapped = F.when(uid < 0, F.lit(2 ** 64 % buckets)).otherwise(F.lit(0))
    return F.pmod(F.pmod(uid, F.lit(buckets)) + wrapped, F.lit(buckets)) == bucket
