"""Mergeable distinct counts and row-level reconciliation."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfunnel.operators import sketches
from adfunnel.plans import lifecycle
from adfunnel.session import new_scratch_path
from adfunnel.sources import fixtures as fx

from .conftest import SF_SMALL


def test_stored_sketches_merge_over_any_range(spark):
    path = new_scratch_path(spark, "sketches")
    users = spark.range(200_000).select((F.col("id") % 30_000).alias("uid"), (F.col("id") % 5).cast("bigint").alias("sid"),
                                        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 172800)").alias("sec"))
    sketches.write_hourly(users, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 48 * 5
    for by in (["d"], ["sid"], ["d", "sid"], []):
        exact = {tuple(r[c] for c in by): (r["n"], r["u"]) for r in users.withColumn("d", F.to_date("sec")).groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("uid").alias("u")).collect()}
        for r in sketches.uniq(stored, by).collect():
            n, u = exact[tuple(r[c] for c in by)]
            assert r["n"] == n and abs(r["uniq"] - u) <= 0.05 * u
    # merging in steps gives the sketch of the whole
    at_once = sketches.uniq(stored, []).first()["uniq"]
    days = sketches.merged(stored, ["d"])
    assert days.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()[0] == at_once
    # a day written again replaces itself alone
    sketches.write_hourly(users.where("sec < timestamp_ntz'2024-01-02 00:00:00'"), path)
    assert spark.read.parquet(path).count() == 48 * 5


def test_sketches_of_nothing(spark):
    none = fx.history_ref_view(spark, SF_SMALL).where("false")
    assert sketches.uniq(sketches.hourly(none), ["sid"]).collect() == []


def test_row_difference_counts_repeated_rows(spark):
    schema = "d string, a int, b string"
    before = [("x", 1, "p")] * 3 + [("x", None, "q"), ("y", 5, "same"), ("z", 9, "not staged")]
    staged = [("x", 1, "p")] * 1 + [("x", None, "q")] * 2 + [("y", 5, "same"), ("w", 2, None)]
    got = lifecycle.row_difference(spark.createDataFrame(before, schema), spark.createDataFrame(staged, schema), ["d"])
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        [("x", 1, "p", "missing", 2), ("x", None, "q", "added", 1), ("w", 2, None, "added", 1)])


def test_a_refused_publish_says_how_many_rows_differ(spark):
    path = new_scratch_path(spark, "main")
    rows = [(f"2024-01-0{d}", 1, i) for d in (1, 2) for i in range(5)]
    make = lambda r: spark.createDataFrame(r, "d string, h int, uid int").withColumn("d", F.col("d").cast("date"))
    lifecycle.publish(spark, make(rows), path, ["d", "h"])
    with pytest.raises(lifecycle.LifecycleError, match="'added': 1") as e:
        lifecycle.publish(spark, make([*rows[1:], ("2024-01-01", 1, 77)]), path, ["d", "h"])
    assert "'missing': 1" in str(e.value)
