"""Write PLANS.md: physical plans of the central jobs on a (d, h)-partitioned event table.

    python scripts/dump_plans.py [--sf-dir DIR]
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()

    from adfunnel.operators import profile
    from adfunnel.plans import daily, lifecycle
    from adfunnel.session import build_session, new_scratch_path
    from adfunnel.sources import fixtures as fx
    from adfunnel.sources import tables

    spark = build_session("local[8]", extra={"spark.sql.maxMetadataStringLength": "100000"})
    path = new_scratch_path(spark, "events")
    tables.write_events(fx.history_ref_view(spark, args.sf_dir), path)
    events = spark.read.parquet(path)
    ssp = fx.ssp_view(spark, args.sf_dir)
    day = dt.date(2024, 1, 10)
    jobs = {
        "daily funnel of one day (plans.daily.funnel_for_day)": daily.funnel_for_day(events, ssp, day),
        "SSP volume profile (operators.profile.volume_by_site_zone)": profile.volume_by_site_zone(events, ssp),
        "completeness gate (plans.lifecycle.completeness)": lifecycle.completeness(events),
        "retention counts (plans.lifecycle.kept_day_counts)": lifecycle.kept_day_counts(events),
    }
    out = ["# PLANS", "",
           "Physical plans (before adaptive re-planning) of the central jobs, on the event table written",
           f"by `sources.tables.write_events` from `{args.sf_dir}` and partitioned by `(d, h)`.",
           "Regenerate with `python scripts/dump_plans.py`.", ""]
    for title, df in jobs.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.replace(path, "<events>")
        out += [f"## {title}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
