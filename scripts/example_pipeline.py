"""End-to-end run of the production flow on the driver's test tables.

    python scripts/example_pipeline.py [--sf-dir /root/testdata/sf0.01]

1. land two days (and the first hours of the third) as tab-separated hour files,
   one per hour and shard, in the layout <root>/<day>/<HH>_<shard>.txt
2. load each day's hour files once per shard into that shard's event table, one job per
   day (load-once, reconciled)
3. load the SSP list from text
4. build the funnel of each complete day from the union of the shard tables
5. profile, check the fill cap, apply retention
Prints a short JSON report.  Everything is written under the session's scratch folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()

    from pyspark.sql import functions as F

    from adfunnel import schema
    from adfunnel.functions import derive
    from adfunnel.operators import profile
    from adfunnel.plans import daily, ingest, lifecycle
    from adfunnel.session import build_session, new_scratch_path
    from adfunnel.sources import fixtures as fx
    from adfunnel.sources import ssp, tables, tsv

    spark = build_session("local[8]")
    h = fx.history_ref_view(spark, args.sf_dir).drop("event_id")
    days = [dt.date(2024, 1, 4), dt.date(2024, 1, 5)]
    landing = new_scratch_path(spark, "landing")
    shard_tables = {s: new_scratch_path(spark, f"events-shard{s}") for s in schema.SHARD_GROUPS}

    # 1. land hour files
    last = dt.datetime.combine(days[-1] + dt.timedelta(days=1), dt.time(2))
    scope = h.where((F.col("sec") >= F.lit(dt.datetime.combine(days[0], dt.time())).cast("timestamp_ntz"))
                    & (F.col("sec") < F.lit(last).cast("timestamp_ntz")))
    hours = [dt.datetime.combine(days[0], dt.time()) + dt.timedelta(hours=i)
             for i in range(int((last - dt.datetime.combine(days[0], dt.time())).total_seconds() // 3600))]
    for hour in hours:
        for s, (lo, hi) in schema.SHARD_GROUPS.items():
            part = scope.where(derive.in_hour(F.col("sec"), hour) & derive.in_user_groups(F.col("uid"), lo, hi))
            tsv.write_tsv(part.coalesce(1), ingest.hour_file(landing, hour, f"s{s}"))

    # 2. load per shard
    loaded = 0
    for s, (lo, hi) in schema.SHARD_GROUPS.items():
        for day in [*days, days[-1] + dt.timedelta(days=1)]:
            r = ingest.load_day_batched(spark, landing, day, f"s{s}", lo, hi, shard_tables[s])
            loaded += len(r.get("report", []))  # one job per day and shard

    # 3. SSP list
    text = new_scratch_path(spark, "ssp-text")
    nation = fx.read_table(spark, args.sf_dir, "nation").where(F.col("n_regionkey").isin(*fx.SSP_REGIONS))
    nation.select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), F.col("n_name"))).coalesce(1) \
        .write.text(text)
    ssp_table = new_scratch_path(spark, "ssp")
    n_sites, _ = ssp.load_sites(spark, text, ssp_table, days[0])

    # 4. funnel per complete day, from the union of the shard tables
    events = tables.union_shards([spark.read.parquet(p) for p in shard_tables.values()])
    union_path = new_scratch_path(spark, "events-all")
    tables.write_events(events, union_path)
    funnel_path = new_scratch_path(spark, "funnel")
    built = []
    for day in days:
        daily.build_day(spark, union_path, spark.read.parquet(ssp_table), day, funnel_path,
                        require_lookahead=True)
        built.append(str(day))

    # 5. profile, fill cap, retention
    funnel = spark.read.parquet(funnel_path)
    report = {
        "hours_loaded": loaded,
        "ssp_sites": n_sites,
        "days_built": built,
        "funnel_rows": funnel.count(),
        "clicked": funnel.where(F.col("ipint_cl") != 0).count(),
        "completeness": [(str(r["d"]), r["n_hours"]) for r in
                         lifecycle.completeness(spark.read.parquet(union_path)).orderBy("d").collect()],
        "ssp_zones_profiled": profile.volume_by_site_zone(spark.read.parquet(union_path),
                                                          spark.read.parquet(ssp_table)).count(),
        "need_fill": lifecycle.need_fill(funnel),
        "retention_removed": [str(d) for d in lifecycle.apply_retention(spark, funnel_path, keep=1)],
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
