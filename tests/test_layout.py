"""Layouts that are read in part: sample buckets, Bloom filters; the streaming funnel."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from adfunnel import schema
from adfunnel.functions import derive
from adfunnel.operators import funnel as fn
from adfunnel.session import local_path, new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import tables
from adfunnel.streaming import funnel as stream

from .conftest import SF_CHECK, SF_SMALL
from .helpers import frame, plan_text, ssp_frame
from .test_funnel_random import random_rows


def _scanned(df) -> int:
    """Rows that the scans of an executed frame gave out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage") or "QueryStage" in node.getClass().getSimpleName():
            stack.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") or "FileSourceScan" in node.getClass().getSimpleName():
            found += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_a_sample_reads_its_buckets_alone(spark):
    name = f"sampled_{uuid.uuid4().hex[:8]}"
    tables.create_sampled_table(spark, name, local_path(new_scratch_path(spark, "sampled")), buckets=24)
    h = fx.history_ref_view(spark, SF_SMALL).withColumn(  # ids of 2^63 and more as well
        "uid", F.when(F.col("event_id") % 5 == 0, F.col("uid") + F.lit(-2 ** 63) + 1).otherwise(F.col("uid")))
    two_days = h.where(F.to_date("sec") <= "2024-01-02")
    try:
        for _ in range(2):  # an hour written again is replaced
            tables.write_sampled(two_days, name)
        assert spark.table(name).count() == two_days.count()
        for n, k in ((10, 3), (240, 7), (1, 0)):
            got = tables.read_sample(spark, name, n, k)
            want = two_days.where(derive.user_sample(F.col("uid"), n, k))
            assert sorted(r["uid"] for r in got.select("uid").collect()) == sorted(r["uid"] for r in want.select("uid").collect())
        # buckets are pruned in any case; the plan names them where the scan stays bucketed
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        text = tables.read_sample(spark, name, 240, 7)._jdf.queryExecution().toString()
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        assert "SelectedBucketsCount: 1 out of 24" in text
        with pytest.raises(ValueError, match="divide"):
            tables.read_sample(spark, name, 7, 1)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_row_groups_without_the_exposure_are_skipped(spark):
    path = new_scratch_path(spark, "bloom")
    # even ids alone, in an order that leaves every row group the whole range
    events = spark.range(400_000).select(
        F.lit("2024-01-01").cast("date").alias("d"), (F.xxhash64("id") % 1_000_000_007 * 2).alias("expid"), F.col("id").alias("sid"))
    tables.write_partitioned(events, path, ["d"], ["sid"], 4)
    table = spark.read.parquet(path)
    lo, hi = table.agg(F.min("expid"), F.max("expid")).first()
    absent = 1 if lo < 1 < hi else lo + 1
    assert _scanned(table.where(F.col("expid") == absent)) == 0
    there = table.first()["expid"]
    assert 0 < _scanned(table.where(F.col("expid") == there)) < 400_000
    traced = tables.trace(table.withColumn("sec", F.lit(0)), [there, absent])
    assert {r["expid"] for r in traced.collect()} == {there}


def _rows(df):
    return sorted((tuple(r[c] for c in schema.FUNNEL_COLUMNS) for r in df.collect()), key=repr)


def test_streamed_rows_of_closed_days_are_those_of_the_build(spark):
    h = fx.history_ref_view(spark, SF_CHECK).where(F.to_date("sec").between("2024-01-02", "2024-01-05"))
    ssp = fx.ssp_view(spark, SF_CHECK)
    events, out = new_scratch_path(spark, "events"), new_scratch_path(spark, "streamed")
    for day in range(2, 6):  # days land one after the other
        tables.write_partitioned(tables.event_table_frame(h.where(F.to_date("sec") == F.lit(dt.date(2024, 1, day))), keep=["event_id"]),
                                 events, ["d"], ["sec"], 1)
        if day in (3, 5):
            stream.start(spark, events, ssp, out, max_files_per_trigger=1, tiebreak=["event_id"]).awaitTermination(600)
    want = fn.funnel(h, ssp, ["event_id"])
    closed = [dt.date(2024, 1, d) for d in (2, 3, 4)]
    got = spark.read.parquet(out)
    assert _rows(got.where(F.col("d").isin(closed))) == _rows(want.where(F.col("d").isin(closed)))
    # of the last day only slots that can get no more
    assert set(_rows(got)) <= set(_rows(want)) and got.count() < want.count()


def test_the_stream_plan_is_right_on_a_batch_and_keeps_one_state(spark):
    rows, ssp = frame(spark, random_rows(31)), ssp_frame(spark, [900])
    got = stream.funnel_stream(rows, ssp, tiebreak=["event_id"])
    assert _rows(got) == _rows(fn.funnel(rows, ssp, ["event_id"]))
    assert "NestedLoop" not in plan_text(got)
    assert stream.SPAN == 8 * 3600 - 1
