"""Hour files landing in a folder -> event table through Structured Streaming."""

import datetime as dt

from pyspark.sql import functions as F

from adfunnel.plans import ingest
from adfunnel.session import new_scratch_path
from adfunnel.sources import fixtures as fx
from adfunnel.sources import tsv
from adfunnel.streaming import hourly

from .conftest import SF_CHECK


def test_stream_loads_each_hour_once(spark, tmp_path):
    h = fx.history_ref_view(spark, SF_CHECK)
    landing = tmp_path / "landing"
    hours = [dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 11)]
    for hr in hours:
        part = h.where(F.col("sec").between(F.lit(hr).cast("timestamp_ntz"),
                                            F.lit(hr + dt.timedelta(seconds=3599)).cast("timestamp_ntz")))
        tsv.write_tsv(part.coalesce(1), str(landing / f"{hr:%Y-%m-%dT%H}"))
    (landing / "junk").mkdir()
    (landing / "junk" / "bad.txt").write_text("not\ta\tvalid\tline\n")
    main = new_scratch_path(spark, "main")
    ckpt = new_scratch_path(spark, "ckpt")
    rej = new_scratch_path(spark, "rej")
    q = hourly.start(spark, str(landing), main, 1, 256, checkpoint=ckpt, rejects_path=rej)
    q.awaitTermination(300)
    assert spark.read.parquet(rej).count() == 1
    got = spark.read.parquet(main)
    expected = sum(ingest.ingest_hour(h, hr, 1, 256).count() for hr in hours)
    assert got.count() == expected > 0
    # a second run over the same folder and checkpoint adds nothing
    q2 = hourly.start(spark, str(landing), main, 1, 256, checkpoint=ckpt)
    q2.awaitTermination(300)
    assert spark.read.parquet(main).count() == expected


def test_stray_row_does_not_block_the_next_hour(spark, tmp_path):
    import pytest

    from .test_lifecycle import hour_text

    day = tmp_path / "landing" / "2024-01-02"
    main = new_scratch_path(spark, "main")
    run = lambda: hourly.start(spark, str(tmp_path / "landing"), main, 1, 256).awaitTermination(300)
    hour_text(day / "05_s1.txt", (1, "05:10:00"), (2, "06:00:00"))
    run()
    hour_text(day / "06_s1.txt", *[(u, "06:10:00") for u in range(50)])
    run()
    got = spark.read.parquet(main)
    assert got.where("h = 5").count() == 1 and got.where("h = 6").count() == 50
    kept = spark.read.option("recursiveFileLookup", "true").parquet(main + "_rejects").collect()
    assert [r["reason"] for r in kept] == ["stray"]
    # a later part of an hour that is present is refused, not dropped
    hour_text(day / "06_s1_part2.txt", (70, "06:20:00"))
    with pytest.raises(Exception, match="would be lost"):
        run()
    assert spark.read.parquet(main).count() == 51
