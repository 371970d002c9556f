"""The command line verbs, run in the test session."""

import datetime as dt

from pyspark.sql import functions as F

from adfunnel import cli
from adfunnel.session import new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import tables, tsv

from .conftest import SF_CHECK


def test_cli_round(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_CHECK)
    hour = dt.datetime(2024, 1, 8, 3)
    f = str(tmp_path / "reg" / "2024-01-08" / "03_s1.txt")
    tsv.write_tsv(h.where(F.col("sec").between(F.lit(hour).cast("timestamp_ntz"),
                                               F.lit(hour + dt.timedelta(seconds=3599)).cast("timestamp_ntz"))), f)
    events = new_scratch_path(spark, "ev")
    code, out = cli.run(spark, ["load-hour", f, "--ug-from", "1", "--ug-to", "256", "--events", events])
    assert code == 0 and out["status"] == "loaded"
    code, out = cli.run(spark, ["load-hour", f, "--ug-from", "1", "--ug-to", "256", "--events", events])
    assert out["status"] == "present"
    assert cli.run(spark, ["need-fill", "--table", events]) == (0, True)

    text = tmp_path / "ssp.txt"
    text.write_text("0\tNATION_0\n1\t\tNATION_1\n")
    sites = new_scratch_path(spark, "ssp")
    assert cli.run(spark, ["load-ssp", str(text), "--table", sites, "--date", "2024-01-31"]) == (0, (2, 0))
    out_path = new_scratch_path(spark, "uid")
    code, msg = cli.run(spark, ["build-day", "2024-01-08", "--events", events, "--ssp", sites, "--out", out_path])
    assert code == 1 and "24 hours" in msg
    code, msg = cli.run(spark, ["build-day", "2024-01-08", "--events", events, "--ssp", sites, "--out", out_path,
                                "--no-gate"])
    assert code == 0 and spark.read.parquet(out_path).count() > 0
    assert cli.run(spark, ["excise", "--table", events, "2024-01-08"]) == (0, 1)
    assert tables.read_partitions(spark, events, ["d", "h"], [(dt.date(2024, 1, 8), 3)]) is None


def test_cli_tables_retention_and_day(spark, tmp_path):
    from adfunnel.session import local_path

    loc = local_path(new_scratch_path(spark, "db"))
    assert cli.run(spark, ["create-tables", "--database", "adf_cli", "--location", loc]) == (0, "ok")
    assert cli.run(spark, ["drop-table", "--database", "adf_cli", "--table", "ssp_sites"]) == (0, "ok")
    assert "ssp_sites" not in {t.name for t in spark.catalog.listTables("adf_cli")}

    h = fx.history_ref_view(spark, SF_CHECK)
    funnel_path = new_scratch_path(spark, "uid")
    tables.write_funnel(daily_rows(spark, h), funnel_path)
    code, removed = cli.run(spark, ["retention", "--table", funnel_path, "--keep", "28"])
    assert code == 0 and len(removed) == 2
    assert cli.run(spark, ["need-fill", "--table", funnel_path, "--cap", "28"]) == (1, False)

    root = tmp_path / "reg"
    hour = dt.datetime(2024, 1, 9, 0)
    tsv.write_tsv(h.where(F.col("sec").between(F.lit(hour).cast("timestamp_ntz"),
                                               F.lit(hour + dt.timedelta(seconds=3599)).cast("timestamp_ntz"))),
                  str(root / "2024-01-09" / "00_s1.txt"))
    events = new_scratch_path(spark, "ev")
    code, out = cli.run(spark, ["load-day", "2024-01-09", "--landing", str(root), "--shard", "s1",
                                     "--ug-from", "1", "--ug-to", "256", "--events", events])
    assert code == 0 and out["status"] == "loaded" and out["missing"] == 23

    sites = new_scratch_path(spark, "ssp")
    fx.ssp_view(spark, SF_CHECK).write.parquet(sites)
    args = ["backfill", "2024-01-10", "--landing", str(root), "--shard", "s1", "--ug-from", "1", "--ug-to", "256",
            "--events", events, "--ssp", sites, "--out", new_scratch_path(spark, "uid"), "--days", "1"]
    assert cli.run(spark, args) == (0, [("2024-01-09", "incomplete")])


def daily_rows(spark, h):
    from adfunnel.operators import funnel as fn

    return fn.funnel(h, fx.ssp_view(spark, SF_CHECK), ["event_id"])
