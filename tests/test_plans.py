"""Plan shape: the funnel shuffles once, joins never degrade to nested loops,
filters and column pruning reach the scan."""

import re

from pyspark.sql import functions as F

from adfunnel.operators import funnel as fn
from adfunnel.operators import membership
from adfunnel.queries import QUERIES
from adfunnel.session import new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import tables

from .conftest import SF_SMALL
from .helpers import plan_text


def exchanges(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if re.search(r"\bExchange hashpartitioning", line)]


def test_funnel_single_shuffle_on_table(spark):
    path = new_scratch_path(spark, "ev")
    tables.write_events(fx.history_ref_view(spark, SF_SMALL), path)
    events = spark.read.parquet(path)
    ssp = spark.createDataFrame([(0, "a"), (5, "b")], "sid bigint, name string")
    plan = plan_text(fn.funnel(events, ssp))
    # one hash exchange for the funnel group key (the dimension's distinct adds one on its side)
    keyed = [e for e in exchanges(plan) if "expid" in e]
    assert len(keyed) == 1, plan
    assert "BroadcastHashJoin" in plan
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan
    # partial aggregation before the exchange (map-side combine)
    assert "partial_min" in plan
    # only the needed columns are read
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    for unused in ("exppr", "custom", "refhash", "ddid", "winexppr"):
        assert unused not in read_schema
    assert "PushedFilters" in plan and "EqualTo(sn,0)" in plan


def test_no_query_uses_nested_loops_or_cartesian(spark):
    for name, q in QUERIES.items():
        plan = plan_text(q(spark, SF_SMALL))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_no_python_udfs(spark):
    for name, q in QUERIES.items():
        plan = plan_text(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_views_read_whole_tables_without_rebalancing(spark):
    for name, q in QUERIES.items():
        assert "RoundRobinPartitioning" not in plan_text(q(spark, SF_SMALL)), name
    from adfunnel.oracle import SQL
    assert not any("BETWEEN 0 AND 49" in s for s in SQL.values())


def test_hour_slice_reaches_the_scan(spark):
    plan = plan_text(QUERIES["ingest_hour_slice"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-05T13:00)" in plan and "LessThan(ts,2024-01-05T14:00)" in plan


def test_membership_literal_list_pushed(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("user_id", "sid")
    plan = plan_text(membership.sites_in(events, [3, 7, 12]))
    assert re.search(r"PushedFilters: \[[^\]]*In\(user_id, \[[\d,]+\]\)", plan), plan


def test_daily_scope_reads_two_partitions(spark):
    import datetime as dt

    from adfunnel.plans import daily

    path = new_scratch_path(spark, "ev")
    tables.write_events(fx.history_ref_view(spark, SF_SMALL), path)
    events = spark.read.parquet(path)
    ssp = spark.createDataFrame([(0, "a")], "sid bigint, name string")
    df = daily.funnel_for_day(events, ssp, dt.date(2024, 1, 9))
    plan = plan_text(df)
    assert "PartitionFilters: [" in plan and "(d#" in plan and "(h#" in plan and "< 2)" in plan
    assert df.where(F.col("d") != F.lit(dt.date(2024, 1, 9))).count() == 0


def test_ssp_membership_broadcasts(spark):
    for key, join in (("volume_by_site_nonssp", "LeftAnti"), ("volume_by_site_zone_ssp", "LeftSemi"),
                      ("funnel_all", "LeftOuter")):
        plan = plan_text(QUERIES[key](spark, SF_SMALL))
        assert f"BroadcastHashJoin" in plan and join in plan, key


def test_retention_counts_without_join(spark):
    plan = plan_text(QUERIES["retention_keep"](spark, SF_SMALL))
    assert "Join" not in plan.replace("BroadcastHashJoin [_ref_page", "").replace("BroadcastHashJoin [_bref_page", "")
