"""TSV dump / load, SSP dimension load, DDL."""

import datetime as dt

from pyspark.sql import functions as F

from adfunnel import schema
from adfunnel.functions import clean
from adfunnel.session import local_path, new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import ssp, tables, tsv

from .conftest import SF_SMALL


def test_tsv_round_trip(spark):
    h = clean.clean(fx.history_ref_view(spark, SF_SMALL).drop("event_id"))
    path = new_scratch_path(spark, "tsv")
    tsv.write_tsv(h, path)
    back, rejects = tsv.read_tsv(spark, path)
    back = clean.fill_defaults(back)
    assert rejects.count() == 0
    key = schema.EVENT_COLUMNS
    assert sorted(map(tuple, h.select(*key).collect())) == sorted(map(tuple, back.select(*key).collect()))


def test_tsv_keeps_blanks_returns_and_large_ids(spark):
    from .helpers import event, frame
    rows = [event(i, "2024-01-01 00:00:01", -1, 0, 3, uid=-2 ** 63 + i, ref=r)
            for i, r in enumerate([" lead", "trail ", "a\rb", "", '""'])]
    h = frame(spark, rows).drop("event_id")
    path = new_scratch_path(spark, "tsv")
    tsv.write_tsv(h, path)
    text = "".join(sorted(r["value"] for r in spark.read.option("lineSep", "\n").text(path).collect()))
    assert "9223372036854775808\t" in text and "18446744073709551615" in text
    back, rejects = tsv.read_tsv(spark, path)
    assert rejects.isEmpty()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, h.select(*schema.EVENT_COLUMNS).collect()))


def test_tsv_rejects(spark, tmp_path):
    good = "\t".join(["5", "2024-01-01 00:00:01", "7", "0", "0", "0", "http://a.b/", "3", "1", "",
                      "9", "3232235521", "0", "1", "0", "0", "0.5", "0", "0", "0", "0", ""])
    fields = good.split("\t")
    big_id = "\t".join(["18446744073709551615"] + fields[1:])
    bad_tn = "\t".join(fields[:3] + ["300"] + fields[4:])
    quoted = "\t".join(fields[:6] + ['http://a"b/'] + fields[7:])
    short = "\t".join(fields[:5])
    empties = "\t".join(fields[:2] + ["", "\\N"] + [""] * 18)
    p = tmp_path / "h.txt"
    p.write_text("\n".join([good, big_id, bad_tn, quoted, short, empties]) + "\n")
    ok, rejects = tsv.read_tsv(spark, str(p))
    ok = clean.clean(ok)
    rows = ok.collect()
    assert len(rows) == 4
    assert rejects.count() == 2
    assert [r["uid"] for r in rows if r["uid"] != 5] == [-1]  # 2^64 - 1 in two's complement
    quoted_row = [r for r in rows if r["ref"].startswith("http://ab")]
    assert quoted_row, "a stray quote must not swallow the following fields"
    empty_row = [r for r in rows if r["expid"] == 0][0]
    assert empty_row["ref"] == "" and empty_row["geo"] == 0 and empty_row["sid"] == 0


def test_ssp_load(spark, tmp_path):
    p = tmp_path / "ssp.txt"
    p.write_text("10\tone\n11\t\ttwo\n12\t\t\tthree\n10\tone again\nx13\tbad\n14\ta\tb\n")
    sites, rejects = ssp.read_ssp_text(spark, str(p), dt.date(2024, 2, 1))
    got = {r["sid"]: (r["name"], r["d"]) for r in sites.collect()}
    assert got == {10: ("one again", dt.date(2024, 2, 1)), 11: ("two", dt.date(2024, 2, 1)),
                   12: ("three", dt.date(2024, 2, 1))}
    assert rejects.count() == 2


def test_ssp_merge_keeps_old_sites(spark):
    old = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 1))],
                                "sid bigint, name string, d date")
    new = spark.createDataFrame([(2, "b2", dt.date(2024, 1, 2)), (3, "c", dt.date(2024, 1, 2))],
                                "sid bigint, name string, d date")
    got = {r["sid"]: r["name"] for r in ssp.merge_sites(old, new).collect()}
    assert got == {1: "a", 2: "b2", 3: "c"}


def test_ddl_idempotent_and_rollback(spark):
    loc = local_path(new_scratch_path(spark, "db"))
    tables.create_tables(spark, "adf_test", loc)
    tables.create_tables(spark, "adf_test", loc)
    names = {t.name for t in spark.catalog.listTables("adf_test")}
    assert {"history_ref", "history_uid", "ssp_sites"} <= names
    cols = [c.name for c in spark.catalog.listColumns("adf_test.history_ref")]
    assert cols[:22] == schema.EVENT_COLUMNS and cols[-3:] == ["d", "h", "shard"]
    tables.drop_table(spark, "adf_test", "history_uid")
    assert "history_uid" not in {t.name for t in spark.catalog.listTables("adf_test")}


def test_event_table_write_layout(spark):
    path = new_scratch_path(spark, "events")
    h = fx.history_ref_view(spark, SF_SMALL)
    tables.write_events(h.where(F.to_date("sec") <= F.lit("2024-01-02")), path)
    back = spark.read.parquet(path)
    assert {"d", "h", "dom", "refhash"} <= set(back.columns)
    days = sorted({str(r["d"]) for r in back.select("d").distinct().collect()})
    assert days == ["2024-01-01", "2024-01-02"]
    plan = back.where((F.col("d") == F.lit("2024-01-01").cast("date")) & (F.col("h") == 3))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(d" in plan


def test_write_splits_a_mass_of_copies(spark):
    """A third of the rows identical: the write still spreads them over several files."""
    h = fx.history_ref_view(spark, SF_SMALL).where(F.to_date("sec") == F.lit("2024-01-02").cast("date"))
    copies = (h.limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(2000))))
              .drop("_copy"))
    path = new_scratch_path(spark, "copies")
    tables.write_partitioned(tables.event_table_frame(h.unionByName(copies)), path, ["d", "h"],
                             tables.EVENT_SORT, cluster_partitions=8, scan=True)
    back = spark.read.parquet(path)
    assert back.count() == h.count() + 2000
    hot = back.groupBy(F.input_file_name().alias("f")).count().where(F.col("count") > 100).count()
    assert hot >= 2


def test_load_sites_twice(spark, tmp_path):
    table = new_scratch_path(spark, "ssp")
    a = tmp_path / "a.txt"
    a.write_text("1\tone\n2\t\ttwo\n")
    assert ssp.load_sites(spark, str(a), table, dt.date(2024, 1, 1)) == (2, 0)
    b = tmp_path / "b.txt"
    b.write_text("2\tTWO\n3\tthree\nbad line\n")
    assert ssp.load_sites(spark, str(b), table, dt.date(2024, 1, 2)) == (3, 1)
    got = {r["sid"]: (r["name"], r["d"]) for r in spark.read.parquet(table).collect()}
    assert got == {1: ("one", dt.date(2024, 1, 1)), 2: ("TWO", dt.date(2024, 1, 2)),
                   3: ("three", dt.date(2024, 1, 2))}


def test_source_hour_from_file_path(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_SMALL).limit(5)
    root = tmp_path / "reg" / "2024-01-01"
    tsv.write_tsv(h, str(root / "07_s1.txt"))
    raw = tsv.with_source_hour(spark.read.option("lineSep", "\n").text(str(root / "07_s1.txt")))
    hours = {r["src_hour"] for r in raw.select("src_hour").collect()}
    assert hours == {dt.datetime(2024, 1, 1, 7)}


def test_shards_and_counts(spark):
    from adfunnel.operators import profile

    df = spark.range(512).withColumnRenamed("id", "uid")
    got = {r["s"]: r["n"] for r in df.groupBy(tables.shard_of().alias("s")).agg(F.count("*").alias("n")).collect()}
    assert got == {1: 256, 2: 256}
    assert profile.row_count(df).first()["n"] == 512
    path = new_scratch_path(spark, "ev")
    tables.write_events(fx.history_ref_view(spark, SF_SMALL).where(F.to_date("sec") == F.lit("2024-01-01").cast("date")),
                        path)
    assert set(tables.read_events(spark, path).columns) >= set(schema.EVENT_COLUMNS) | {"dom", "refhash", "d", "h"}
