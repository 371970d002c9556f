"""Scalar expressions on hand-made values (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adfunnel.functions import clean, derive, urls
from adfunnel.sources import tsv

from .helpers import event, frame


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_scheme_repair(spark):
    rows = [(197671, ""), (197671, "ya.ru/x"), (197671, "https://ya.ru"), (187537, "1.google"),
            (187537, "http://x.google"), (187537, ""), (5, "ya.ru")]
    df = spark.createDataFrame(rows, "sid bigint, ref string")
    got = [r[0] for r in df.select(clean.repair_scheme(F.col("ref"), F.col("sid"))).collect()]
    assert got == ["http://", "http://ya.ru/x", "https://ya.ru", "http://1.google",
                   "http://http://x.google", "", "ya.ru"]


def test_strip_breaking(spark):
    got = one(spark, clean.strip_breaking, ["a\nb\tc'd\"e\\f\rg", None, ""])
    assert got == ["abcdef\rg", None, ""]


def test_defaults_and_order(spark):
    r = event(1, "2024-01-01 00:00:00", 5, 0, 197671, ref=None)
    r["ref"] = None
    r["custom"] = "a\tb"
    for c in ("sz", "geo", "ipint", "exppr", "ddid", "bref", "stn"):
        r[c] = None
    df = clean.clean(frame(spark, [r]).drop("event_id"))
    out = df.first().asDict()
    # defaults first, then repair: a missing ref of the scheme-less site becomes "http://"
    assert out["ref"] == "http://" and out["bref"] == "" and out["custom"] == "ab"
    assert out["sz"] == 0 and out["geo"] == 0 and out["ipint"] == 0 and out["exppr"] == 0.0
    assert out["stn"] == 0 and out["uid"] == 1001


def test_rejects_without_user_or_time(spark):
    a = event(1, "2024-01-01 00:00:00", 5, 0, 1)
    b = event(2, "2024-01-01 00:00:00", 5, 0, 1)
    b["uid"] = None
    c = event(3, "2024-01-01 00:00:00", 5, 0, 1)
    c["sec"] = None
    ok, bad = clean.split_rejects(frame(spark, [a, b, c]))
    assert [r["event_id"] for r in ok.collect()] == [1]
    assert sorted(r["event_id"] for r in bad.collect()) == [2, 3]


@pytest.mark.parametrize("url,dom", [
    ("http://www.Example.com:8080/a?b#c", "example.com"),
    ("https://user:pw@WWW.www.x.org/", "www.x.org"),
    ("//cdn.site.net/x", "cdn.site.net"),
    ("ya.ru/x", ""),
    ("", ""),
    ("svn+ssh://repo.host.io/trunk", "repo.host.io"),
    ("http://x.google", "x.google"),
])
def test_domain_without_www(spark, url, dom):
    assert one(spark, urls.domain_without_www, [url]) == [dom]


def test_fingerprint_ignores_one_trailing_char(spark):
    a, b, c, d = one(spark, urls.url_fingerprint, ["http://a.b/x", "http://a.b/x/", "http://a.b/x?", "http://a.b/y"])
    assert a == b == c and a != d and len(a) == 32


def test_ipv4(spark):
    assert one(spark, derive.ipv4_text, [3232235521, 0, 4294967295], "bigint") == \
        ["192.168.0.1", "0.0.0.0", "255.255.255.255"]
    assert one(spark, derive.ipv4_text_or_empty, [0, 16909060], "bigint") == ["", "1.2.3.4"]
    assert one(spark, derive.present, [0, 5], "bigint") == [0, 1]


def test_user_groups(spark):
    assert one(spark, derive.user_group, [0, 255, 256, 511], "bigint") == [1, 256, 1, 256]
    for lo, hi in ((0, 5), (5, 4), (1, 0)):
        with pytest.raises(ValueError):
            derive.in_user_groups(F.col("uid"), lo, hi)


def test_hour_window_is_half_open(spark):
    h = dt.datetime(2024, 1, 5, 13)
    vals = [dt.datetime(2024, 1, 5, 12, 59, 59), dt.datetime(2024, 1, 5, 13), dt.datetime(2024, 1, 5, 13, 59, 59),
            dt.datetime(2024, 1, 5, 14)]
    df = spark.createDataFrame([(v,) for v in vals], "x timestamp_ntz")
    got = [r[0] for r in df.select(derive.in_hour(F.col("x"), h)).collect()]
    assert got == [False, True, True, False]


def test_window_end(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2017-03-02 22:00:00' AS s")
    got = df.select(derive.format_window(derive.window_end(F.col("s"), 4, 5))).first()[0]
    assert got == "2017-03-03T02:04:59"
    got0 = df.select(derive.format_window(derive.window_end(F.col("s"), 0))).first()[0]
    assert got0 == "2017-03-02T21:59:59"


def test_hour_key(spark):
    got = one(spark, tsv.hour_key, ["../../reg_history_ref/2017-05-15/04_s1.txt", "2017-06-25T05",
                                    "x2017_13_01_00", "no hour here", "2017-05-15"])
    assert got == [dt.datetime(2017, 5, 15, 4), dt.datetime(2017, 6, 25, 5), None, None, None]


def test_user_sample_is_per_user(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("uid"), F.col("id"))
    kept = df.where(derive.user_sample(F.col("uid"), 10, 3))
    users = {r["uid"] for r in kept.collect()}
    assert users == {u for u in range(37) if u % 10 == 3}
    with pytest.raises(ValueError):
        derive.user_sample(F.col("uid"), 10, 10)


def test_all_twenty_defaults(spark):
    from adfunnel import schema

    r = event(1, "2024-01-01 00:00:00", 5, 0, 3)
    for c in schema.NUMERIC_DEFAULTED + schema.STRING_DEFAULTED:
        r[c] = None
    assert len(schema.NUMERIC_DEFAULTED) == 17 and len(schema.STRING_DEFAULTED) == 3
    out = clean.fill_defaults(frame(spark, [r]).drop("event_id")).first().asDict()
    assert all(out[c] == 0 for c in schema.NUMERIC_DEFAULTED)
    assert all(out[c] == "" for c in schema.STRING_DEFAULTED)
    assert out["uid"] == 1001 and out["sec"] is not None
