"""The dated SSP list: versions, validity, as-of membership; the switch of the undated list."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adfunnel import schema
from adfunnel.operators import funnel as fn
from adfunnel.operators import membership, profile
from adfunnel.session import new_scratch_path
from adfunnel.sources import ssp, ssp_history, tables

from . import brute
from .helpers import event, frame, plan_text
from .test_funnel_random import random_rows

D = dt.date


def _version(spark, rows):
    return spark.createDataFrame(rows, "sid bigint, name string, d date")


def test_versions_are_loaded_side_by_side(spark, tmp_path):
    table = new_scratch_path(spark, "versions")
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("1\tone\n2\t\ttwo\nbad\n")
    b.write_text("2\tTWO\n3\tthree\n")
    assert ssp_history.add_version(spark, str(a), table, D(2024, 1, 1)) == (2, 1)
    assert ssp_history.add_version(spark, str(b), table, D(2024, 1, 5)) == (2, 0)
    assert ssp_history.add_version(spark, str(a), table, D(2024, 1, 1)) == (2, 1)  # again: the same
    versions = ssp_history.read_versions(spark, table)
    assert versions.count() == 4
    (tmp_path / "none.txt").write_text("bad\n")
    with pytest.raises(ValueError, match="names no site"):
        ssp_history.add_version(spark, str(tmp_path / "none.txt"), table, D(2024, 1, 5))
    stays = {tuple(r) for r in ssp_history.validity(versions).collect()}
    assert stays == {(1, "one", D(2024, 1, 1), None), (2, "two", D(2024, 1, 1), D(2024, 1, 5)),
                     (2, "TWO", D(2024, 1, 5), None), (3, "three", D(2024, 1, 5), None)}
    leaves = ssp_history.validity(versions, forget=True)
    assert {tuple(r) for r in leaves.collect()} == {
        (1, "one", D(2024, 1, 1), D(2024, 1, 5)), (2, "two", D(2024, 1, 1), D(2024, 1, 5)),
        (2, "TWO", D(2024, 1, 5), None), (3, "three", D(2024, 1, 5), None)}
    for day, sids in ((D(2023, 12, 31), set()), (D(2024, 1, 4), {1, 2}), (D(2024, 1, 5), {2, 3}), (D(2030, 1, 1), {2, 3})):
        assert {r["sid"] for r in ssp_history.list_of(leaves, day).collect()} == sids


def test_a_site_that_leaves_and_comes_back(spark):
    rows = [(1, "x", D(2024, 1, 1)), (9, "k", D(2024, 1, 1)), (9, "k", D(2024, 1, 2)), (1, "x", D(2024, 1, 3)), (1, "w", D(2024, 1, 3)),
            (9, "k", D(2024, 1, 3)), (None, "n", D(2024, 1, 3)), (4, "n", None)]
    got = ssp_history.validity(_version(spark, rows), forget=True).orderBy("sid", "valid_from").collect()
    assert [tuple(r) for r in got] == [(1, "x", D(2024, 1, 1), D(2024, 1, 2)), (1, "x", D(2024, 1, 3), None),
                                       (9, "k", D(2024, 1, 1), None)]
    assert ssp_history.validity(_version(spark, []), forget=True).collect() == []


def test_funnel_goes_by_the_list_of_the_processed_day(spark):
    rows = random_rows(11)
    # site 900 joins on the second day and leaves on the third, site 5 joins on the third
    versions = _version(spark, [(900, "a", D(2024, 5, 2)), (5, "b", D(2024, 5, 3))])
    dated = ssp_history.validity(versions, forget=True)
    got = fn.funnel(frame(spark, rows), dated, tiebreak=["event_id"]).collect()
    lists = {D(2024, 4, 30): set(), D(2024, 5, 1): set(), D(2024, 5, 2): {900}, D(2024, 5, 3): {5}, D(2024, 5, 4): {5}}
    want = [r for day, sids in lists.items() for r in brute.funnel(rows, sids) if r[-1] == day]
    assert sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in got), key=repr) == sorted(want, key=repr)
    assert len(want) > 50


def test_asof_membership_is_one_hash_join(spark):
    events = frame(spark, [event(i, f"2024-01-0{d} 10:00:00", 1, 0, 7) for i, d in enumerate((1, 2, 3), 1)])
    dated = ssp_history.validity(_version(spark, [(7, "x", D(2024, 1, 2)), (8, "y", D(2024, 1, 3))]), forget=True)
    rows = profile.volume_by_site_asof(events, dated)
    assert [tuple(r) for r in rows.collect()] == [
        (D(2024, 1, 1), 7, False, 1), (D(2024, 1, 2), 7, True, 1), (D(2024, 1, 3), 7, False, 1)]
    marked = membership.mark_ssp_asof(events.withColumn("d", F.to_date("sec")), dated, "d")
    assert "BroadcastHashJoin" in plan_text(marked) and "NestedLoop" not in plan_text(marked)


def test_a_list_is_switched_and_a_cut_switch_settled(spark, tmp_path):
    table = new_scratch_path(spark, "ssp")
    text = tmp_path / "list.txt"
    text.write_text("1\tone\n2\ttwo\n")
    assert ssp.load_sites(spark, str(text), table, D(2024, 1, 1)) == (2, 0)
    text.write_text("2\tTWO\n3\tthree\n")
    assert ssp.load_sites(spark, str(text), table, D(2024, 1, 2)) == (3, 0)
    read = lambda: {r["sid"]: r["name"] for r in spark.read.parquet(table).collect()}
    assert read() == {1: "one", 2: "TWO", 3: "three"}
    # cut after the old copy was set aside: it comes back; cut before its removal: it goes
    fs, old = tables._fs_path(spark, table + "__old")
    fs.rename(tables._fs_path(spark, table)[1], old)
    tables.settle_folder(spark, table)
    spark.catalog.refreshByPath(table)
    assert read() == {1: "one", 2: "TWO", 3: "three"} and not fs.exists(old)
    spark.createDataFrame([(9, "x", D(2024, 1, 1))], "sid bigint, name string, d date").write.parquet(table + "__old")
    tables.settle_folder(spark, table)
    assert not fs.exists(old) and read() == {1: "one", 2: "TWO", 3: "three"}
