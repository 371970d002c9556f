"""Retention, fill cap, day and hour lists, publish / reconcile, backfill."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adfunnel import schema
from adfunnel.plans import daily, ingest, lifecycle
from adfunnel.session import new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import tables, tsv

from .conftest import SF_CHECK, SF_SMALL
from .helpers import event, frame, plan_text


def days_table(spark, n):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(n) for _ in range(2)]
    return spark.createDataFrame(rows, "d date, v int")


@pytest.mark.parametrize("n,expired", [(13, 0), (14, 0), (15, 1), (20, 6)])
def test_expired_days(spark, n, expired):
    t = days_table(spark, n)
    exp = sorted(r["d"] for r in lifecycle.expired_days(t).collect())
    assert len(exp) == expired
    assert exp == [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(expired)]
    assert lifecycle.kept_days(t).count() == min(n, 14)


@pytest.mark.parametrize("n,need", [(20, True), (21, False), (22, False)])
def test_fill_cap(spark, n, need):
    assert lifecycle.need_fill(days_table(spark, n)) is need


def test_day_and_hour_lists(spark):
    days = [r["d"] for r in lifecycle.day_list(spark, dt.date(2024, 3, 1)).collect()]
    assert days[0] == dt.date(2024, 2, 17) and days[-1] == dt.date(2024, 2, 29) and len(days) == 13
    hours = lifecycle.hour_list(lifecycle.day_list(spark, dt.date(2024, 3, 1), 2)).collect()
    assert len(hours) == 48


def test_parse_day():
    with pytest.raises(ValueError):
        lifecycle.parse_day("2024/01/01")
    assert lifecycle.parse_day("2024-01-09") == dt.date(2024, 1, 9)


def test_completeness_gate(spark):
    h = fx.history_ref_view(spark, SF_SMALL)
    assert not lifecycle.day_is_complete(h, dt.date(2024, 1, 3))
    h2 = fx.history_ref_view(spark, SF_CHECK)
    assert lifecycle.day_is_complete(h2, dt.date(2024, 1, 3))


def test_retention_on_table(spark):
    path = new_scratch_path(spark, "ret")
    h = fx.history_ref_view(spark, SF_SMALL)
    tables.write_funnel(daily.fn.funnel(h, fx.ssp_view(spark, SF_SMALL), ["event_id"]), path)
    before_days = spark.read.parquet(path).select("d").distinct().count()
    removed = lifecycle.apply_retention(spark, path, keep=14)
    assert len(removed) == before_days - 14
    after = spark.read.parquet(path)
    assert after.select("d").distinct().count() == 14
    assert after.where(F.col("d").isin(removed)).count() == 0
    assert lifecycle.apply_retention(spark, path, keep=14) == []


def test_excise(spark):
    path = new_scratch_path(spark, "exc")
    h = fx.history_ref_view(spark, SF_SMALL)
    tables.write_events(h, path)
    n = lifecycle.excise_days(spark, path, "2024-01-10", "2024-01-12")
    assert n == 3
    left = spark.read.parquet(path)
    assert left.where(F.col("d").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))).count() == 0
    with pytest.raises(ValueError):
        lifecycle.excise_days(spark, path, "2024-01-12", "2024-01-10")


def test_publish_once_and_rerun(spark):
    main = new_scratch_path(spark, "main")
    h = fx.history_ref_view(spark, SF_CHECK)
    hour = dt.datetime(2024, 1, 7, 9)
    first = ingest.load_hour(spark, h, hour, 1, 256, main)
    assert first["status"] == "loaded" and all(r["ok"] for r in first["report"])
    n = spark.read.parquet(main).count()
    assert n == sum(r["staged"] for r in first["report"]) > 0
    again = ingest.load_hour(spark, h, hour, 1, 256, main)
    assert again["status"] == "present"
    from adfunnel.session import scratch_dir
    import glob
    assert not glob.glob(scratch_dir(spark).replace("file:", "") + "/stage-20240107T09-*"), "stage left behind"
    assert spark.read.parquet(main).count() == n
    nxt = ingest.load_hour(spark, h, hour + dt.timedelta(hours=1), 1, 128, main)
    assert nxt["status"] == "loaded"
    report = nxt["report"][0]
    assert report["before"] == 0 and report["after"] == report["staged"]


def test_publish_refuses_empty_stage(spark):
    main = new_scratch_path(spark, "main")
    empty = tables.event_table_frame(fx.history_ref_view(spark, SF_SMALL)).limit(0)
    with pytest.raises(lifecycle.LifecycleError):
        lifecycle.publish(spark, empty, main)


def test_load_hour_file(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_CHECK)
    hour = dt.datetime(2024, 1, 9, 17)
    landing = tmp_path / "reg" / "2024-01-09"
    tsv.write_tsv(h.where(F.col("sec").between(F.lit("2024-01-09 17:00:00").cast("timestamp_ntz"),
                                               F.lit("2024-01-09 17:59:59").cast("timestamp_ntz"))),
                  str(landing / "17_s1.txt"))
    main = new_scratch_path(spark, "main")
    out = ingest.load_hour_file(spark, str(landing / "17_s1.txt"), 1, 256, main)
    assert out["status"] == "loaded"
    expected = ingest.ingest_hour(h, hour, 1, 256).count()
    assert spark.read.parquet(main).count() == expected > 0


def test_build_day_gate_and_idempotence(spark):
    events = new_scratch_path(spark, "ev")
    h = fx.history_ref_view(spark, SF_CHECK)
    tables.write_events(h.where(F.to_date("sec").between(F.lit("2024-01-04").cast("date"),
                                                         F.lit("2024-01-06").cast("date"))), events)
    ssp = fx.ssp_view(spark, SF_CHECK)
    out = new_scratch_path(spark, "uid")
    day = dt.date(2024, 1, 5)
    # the table has no event_id: ties on time fall back to the payload order
    daily.build_day(spark, events, ssp, day, out)
    first = sorted(map(tuple, spark.read.parquet(out).select(*schema.FUNNEL_COLUMNS).collect()))
    daily.build_day(spark, events, ssp, day, out)
    assert sorted(map(tuple, spark.read.parquet(out).select(*schema.FUNNEL_COLUMNS).collect())) == first
    expected = daily.fn.funnel(h.drop("event_id"), ssp).where(F.col("d") == F.lit(day))
    assert sorted(map(tuple, expected.collect())) == first and len(first) > 0
    with pytest.raises(daily.IncompleteDay):
        daily.build_day(spark, events, ssp, dt.date(2024, 1, 7), out)
    # the last loaded day has no next day yet: the lookahead gate holds it back
    with pytest.raises(daily.IncompleteDay):
        daily.build_day(spark, events, ssp, dt.date(2024, 1, 6), out, require_lookahead=True)
    daily.build_day(spark, events, ssp, day, out, require_lookahead=True)


def test_day_scope_prunes_partitions(spark):
    events = new_scratch_path(spark, "ev")
    h = fx.history_ref_view(spark, SF_SMALL)
    tables.write_events(h, events)
    scoped = daily.day_scope(spark.read.parquet(events), dt.date(2024, 1, 5))
    plan = plan_text(scoped)
    assert "PartitionFilters: [" in plan and "= 2024-01-06)" in plan and "< 2)" in plan
    hours = {(str(r["d"]), r["h"]) for r in scoped.select("d", "h").distinct().collect()}
    assert hours == {("2024-01-05", h) for h in range(24) if ("2024-01-05", h) in hours} | \
        {(d, h) for d, h in hours if d == "2024-01-06"}
    assert all(h < 2 for d, h in hours if d == "2024-01-06")


def test_backfill_loop(spark):
    ev_path, uid_path = new_scratch_path(spark, "ev"), new_scratch_path(spark, "uid")
    h = fx.history_ref_view(spark, SF_CHECK)
    ssp = fx.ssp_view(spark, SF_CHECK)
    loaded = []

    def load_day(day):
        loaded.append(day)
        tables.write_events(h.where(F.to_date("sec").isin(day, day + dt.timedelta(days=1))), ev_path)

    done = daily.backfill(spark, dt.date(2024, 1, 4), load_day, ev_path, uid_path, ssp, days=2)
    assert loaded == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    # the second load wrote hours 0 and 1 of the first day's next day anew
    assert [s for _, s in done] == ["built", "rebuilt", "built"]
    assert spark.read.parquet(uid_path).select("d").distinct().count() == 2


@pytest.mark.parametrize("repair", [False, True])
def test_backfill_rebuilds_a_day_when_its_late_hours_arrive(spark, repair):
    ev_path, uid_path = new_scratch_path(spark, "ev"), new_scratch_path(spark, "uid")
    h = fx.history_ref_view(spark, SF_CHECK)
    ssp = fx.ssp_view(spark, SF_CHECK)

    def load_day(day):  # one day at a time, as the hourly loads would land
        tables.write_events(h.where(F.to_date("sec") == F.lit(day)), ev_path)

    done = daily.backfill(spark, dt.date(2024, 1, 4), load_day, ev_path, uid_path, ssp, days=2, repair_late=repair)
    assert done == [(dt.date(2024, 1, 2), "built"), (dt.date(2024, 1, 2), "repaired" if repair else "rebuilt"),
                    (dt.date(2024, 1, 3), "built")]
    # after the rebuild, day 2 equals a build that saw the next day's first hours
    got = sorted(map(tuple, spark.read.parquet(uid_path).where(F.col("d") == F.lit(dt.date(2024, 1, 2)))
                     .select(*schema.FUNNEL_COLUMNS).collect()))
    full = daily.fn.funnel(h.drop("event_id"), ssp).where(F.col("d") == F.lit(dt.date(2024, 1, 2)))
    assert got == sorted(map(tuple, full.collect()))


def test_hour_probe(spark):
    rows = [event(1, "2024-01-01 05:10:00", 1, 0, 1)]
    t = frame(spark, rows)
    assert lifecycle.hour_present(t, dt.datetime(2024, 1, 1, 5))
    assert not lifecycle.hour_present(t, dt.datetime(2024, 1, 1, 6))


def test_load_day_files(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_CHECK)
    day = dt.date(2024, 1, 3)
    root = tmp_path / "reg"
    for hr in (5, 6):
        start = dt.datetime.combine(day, dt.time(hr))
        part = h.where(F.col("sec").between(F.lit(start).cast("timestamp_ntz"),
                                            F.lit(start + dt.timedelta(seconds=3599)).cast("timestamp_ntz")))
        tsv.write_tsv(part.coalesce(1), ingest.hour_file(str(root), start, "s1"))
    main = new_scratch_path(spark, "main")
    statuses = [r["status"] for r in ingest.load_day_files(spark, str(root), day, "s1", 1, 256, main)]
    assert statuses.count("loaded") == 2 and statuses.count("missing") == 22
    again = [r["status"] for r in ingest.load_day_files(spark, str(root), day, "s1", 1, 256, main)]
    assert again.count("present") == 2


def test_drop_days_of_catalog_table(spark):
    from adfunnel.session import local_path

    loc = local_path(new_scratch_path(spark, "db"))
    tables.create_tables(spark, "adf_drop", loc)
    h = fx.history_ref_view(spark, SF_SMALL)
    rows = tables.event_table_frame(h).where(F.col("d") <= F.lit("2024-01-03").cast("date"))
    rows = rows.withColumn("shard", F.lit(tables.shard_label(1, 256)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto("adf_drop.history_ref")
    n = lifecycle.drop_table_days(spark, "adf_drop.history_ref", [dt.date(2024, 1, 2)])
    assert n == 1
    days = {r["d"] for r in spark.table("adf_drop.history_ref").select("d").distinct().collect()}
    assert days == {dt.date(2024, 1, 1), dt.date(2024, 1, 3)}


def test_empty_hour_file_is_not_published(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_SMALL)
    f = str(tmp_path / "reg" / "2024-01-02" / "04_s1.txt")
    tsv.write_tsv(h.where(F.lit(False)), f)
    main = new_scratch_path(spark, "main")
    assert ingest.load_hour_file(spark, f, 1, 256, main)["status"] == "empty"
    assert tables.read_if_exists(spark, main) is None


def test_rejects_kept_per_hour(spark, tmp_path):
    f = tmp_path / "reg" / "2024-01-02" / "05_s1.txt"
    f.parent.mkdir(parents=True)
    good = "\t".join(["5", "2024-01-02 05:00:01", "7", "0", "0", "0", "http://a.b/", "3", "1", "",
                      "9", "3232235521", "0", "1", "0", "0", "0.5", "0", "0", "0", "0", ""])
    fields = good.split("\t")
    f.write_text("\n".join([good, "\t".join(["18446744073709551615"] + fields[1:]), "short\tline",
                            "\t".join([""] + fields[1:])]) + "\n")
    main, rej = new_scratch_path(spark, "main"), new_scratch_path(spark, "rej")
    for _ in range(2):  # rerun: same rejects, not twice as many
        out = ingest.load_hour_file(spark, str(f), 1, 256, main, rejects_path=rej)
    assert out["status"] == "present"
    assert sorted(r["reason"] for r in spark.read.parquet(rej).collect()) == ["no_key", "rejected"]
    assert {r["uid"] for r in spark.read.parquet(main).collect()} == {5, -1}


LINE = "\t".join(["{uid}", "2024-01-02 {time}", "7", "0", "0", "0", "http://a.b/", "3", "1", "",
                  "9", "3232235521", "0", "1", "0", "0", "0.5", "0", "0", "0", "0", ""])


def hour_text(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(LINE.format(uid=u, time=t) + "\n" for u, t in rows))


def test_four_lines_in_four_accounted_for(spark, tmp_path):
    f = tmp_path / "reg" / "2024-01-02" / "05_s1.txt"
    hour_text(f, (5, "05:00:01"), (2 ** 63, "05:00:02"), (2 ** 64 - 1, "05:59:59"), (6, "06:00:00"))
    main = new_scratch_path(spark, "main")
    out = ingest.load_hour_file(spark, str(f), 1, 256, main)
    assert (out["lines"], out["loaded"], out["stray"], out["rejected"]) == (4, 3, 1, 0)
    kept = spark.read.parquet(out["rejects"]).collect()
    assert [(r["reason"], r["line"].split("\t")[0]) for r in kept] == [("stray", "6")]
    assert {r["uid"] for r in spark.read.parquet(main).collect()} == {5, -2 ** 63, -1}


def test_second_shard_of_an_hour_is_loaded(spark, tmp_path):
    f = tmp_path / "reg" / "2024-01-02" / "05_s1.txt"
    hour_text(f, *[(u, "05:00:01") for u in (*range(0, 50), *range(128, 178))])
    for load in (lambda lo, hi, m: ingest.load_hour_file(spark, str(f), lo, hi, m),
                 lambda lo, hi, m: ingest.load_day_batched(spark, str(tmp_path / "reg"), dt.date(2024, 1, 2), "s1",
                                                           lo, hi, m)):
        main = new_scratch_path(spark, "main")
        first, second = load(1, 128, main), load(129, 256, main)
        assert first["loaded"] == second["loaded"] == 50 and first["other_groups"] == 50
        assert spark.read.parquet(main).select("uid").distinct().count() == 100
        with pytest.raises(lifecycle.LifecycleError):  # overlaps units that are loaded
            load(1, 256, main)
        assert spark.read.parquet(main).count() == 100


def test_an_empty_folder_does_not_block_its_hour(spark, tmp_path):
    from adfunnel.session import local_path
    import pathlib
    f = tmp_path / "reg" / "2024-01-02" / "05_s1.txt"
    hour_text(f, (5, "05:00:01"))
    main = new_scratch_path(spark, "main")
    pathlib.Path(local_path(main), "d=2024-01-02", "h=5", "shard=g001_256").mkdir(parents=True)
    assert ingest.load_day_batched(spark, str(tmp_path / "reg"), dt.date(2024, 1, 2), "s1", 1, 256, main)["loaded"] == 1


def test_an_emptied_day_leaves_no_rows(spark):
    events, out = new_scratch_path(spark, "ev"), new_scratch_path(spark, "uid")
    ssp = fx.ssp_view(spark, SF_SMALL)
    day = dt.date(2024, 1, 5)
    h = fx.history_ref_view(spark, SF_SMALL)
    tables.write_events(h, events)
    daily.build_day(spark, events, ssp, day, out, require_complete=False)
    daily.build_day(spark, events, ssp, day + dt.timedelta(days=1), out, require_complete=False)
    other = new_scratch_path(spark, "ev")
    tables.write_events(h.where("expid = 0"), other)
    daily.build_day(spark, other, ssp, day, out, require_complete=False)
    assert {r["d"] for r in spark.read.parquet(out).select("d").distinct().collect()} == {day + dt.timedelta(days=1)}


def test_second_backfill_builds_nothing(spark):
    ev_path, uid_path = new_scratch_path(spark, "ev"), new_scratch_path(spark, "uid")
    h = fx.history_ref_view(spark, SF_CHECK)
    ssp = fx.ssp_view(spark, SF_CHECK)

    def load_day(day):  # a day is loaded once
        if day not in tables.listed_days(spark, ev_path):
            tables.write_events(h.where(F.to_date("sec") == F.lit(day)), ev_path)

    run = lambda: daily.backfill(spark, dt.date(2024, 1, 4), load_day, ev_path, uid_path, ssp, days=2)
    assert len(run()) == 3 and run() == []
    tables.write_events(h.where(F.to_date("sec") == F.lit(dt.date(2024, 1, 4))), ev_path)  # late clicks of day 3
    assert run() == [(dt.date(2024, 1, 3), "rebuilt")]


def test_publish_replace_reloads_an_hour(spark):
    main = new_scratch_path(spark, "main")
    h = fx.history_ref_view(spark, SF_CHECK)
    hour = dt.datetime(2024, 1, 11, 8)
    rows = ingest.ingest_hour(h, hour, 1, 256)
    lifecycle.publish(spark, rows, main)
    fewer = rows.where(F.col("uid") % 2 == 0)
    replayed = lifecycle.publish(spark, rows, main)
    assert replayed[0]["action"] == "replay" and replayed[0]["after"] == replayed[0]["before"] == rows.count()
    with pytest.raises(lifecycle.LifecycleError):
        lifecycle.publish(spark, fewer, main)
    assert spark.read.parquet(main).count() == rows.count()
    replaced = lifecycle.publish(spark, fewer, main, replace=True)
    assert replaced[0]["after"] == fewer.count() < rows.count() and replaced[0]["ok"]


def test_batched_day_load_equals_hour_by_hour(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_CHECK)
    day = dt.date(2024, 1, 12)
    root = tmp_path / "reg"
    for hr in (0, 1, 7):
        start = dt.datetime.combine(day, dt.time(hr))
        part = h.where(F.col("sec").between(F.lit(start).cast("timestamp_ntz"),
                                            F.lit(start + dt.timedelta(seconds=3599)).cast("timestamp_ntz")))
        tsv.write_tsv(part.coalesce(1), ingest.hour_file(str(root), start, "s1"))
    one_by_one, batched = new_scratch_path(spark, "a"), new_scratch_path(spark, "b")
    ingest.load_day_files(spark, str(root), day, "s1", 1, 128, one_by_one)
    # pre-load hour 1 so the batched load must skip it
    ingest.load_hour_file(spark, ingest.hour_file(str(root), dt.datetime.combine(day, dt.time(1)), "s1"),
                          1, 128, batched)
    out = ingest.load_day_batched(spark, str(root), day, "s1", 1, 128, batched)
    assert out["status"] == "loaded" and out["present"] == 1 and len(out["report"]) == 2
    cols = sorted(spark.read.parquet(one_by_one).columns)
    a = sorted(map(tuple, spark.read.parquet(one_by_one).select(*cols).collect()))
    b = sorted(map(tuple, spark.read.parquet(batched).select(*cols).collect()))
    assert a == b and len(a) > 0
    assert ingest.load_day_batched(spark, str(root), day, "s1", 1, 128, batched)["status"] == "nothing to load"
