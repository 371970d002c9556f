"""Hours that come in parts: every file once, whatever is delivered again or cut short."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfunnel.plans import ingest, lifecycle, parts
from adfunnel.session import new_scratch_path
from adfunnel.sources import ledger, tables
from adfunnel.streaming import hourly

from .test_lifecycle import hour_text

DAY = "2024-01-02"


def _users(spark, path):
    return Counter(r["uid"] for r in spark.read.parquet(path).select("uid").collect())


def _load(spark, root, main, **more):
    return parts.load_parts(spark, [str(root)], 1, 256, main, **more)


def test_parts_of_an_hour_are_added_and_counted_once(spark, tmp_path):
    root = tmp_path / DAY
    main = new_scratch_path(spark, "main")
    hour_text(root / "06_s1.txt", (1, "06:10:00"), (2, "06:20:00"))
    first = _load(spark, root, main)
    assert list(first["files"]) == ["new"] and first["loaded"] == 2
    assert _load(spark, root, main)["status"] == "nothing to load"
    hour_text(root / "06_s1_part2.txt", (3, "06:30:00"), (1, "06:10:00"))  # a row of the first part again: both are data
    hour_text(root / "06_s1_copy.txt", (2, "06:20:00"), (1, "06:10:00"))  # the first part, other name and order
    hour_text(root / "07_s1.txt", (9, "07:00:00"), (8, "06:59:59"))  # the second is of another hour
    (root / "08_s1.txt").write_text("")
    second = _load(spark, root, main)
    names = {k: [p.rsplit("/", 1)[1] for p in v] for k, v in second["files"].items()}
    assert names == {"duplicate": ["06_s1_copy.txt"], "known": ["06_s1.txt"], "new": ["06_s1_part2.txt", "07_s1.txt"]}
    assert _users(spark, main) == Counter({1: 2, 2: 1, 3: 1, 9: 1}) and second["stray"] == 1
    assert _load(spark, root, main)["status"] == "nothing to load"
    assert tables.listed_hours(spark, main, dt.date(2024, 1, 2)) == [6, 7]
    assert sum(r["action"] == "write" for r in second["report"]) == 2
    rejects = spark.read.parquet(main + "_rejects").collect()
    assert [r["reason"] for r in rejects] == ["stray"]


def test_the_same_content_twice_in_one_batch_is_loaded_once(spark, tmp_path):
    root = tmp_path / DAY
    main = new_scratch_path(spark, "main")
    for name in ("06_b.txt", "06_a.txt", "06_c.txt"):
        hour_text(root / name, (1, "06:10:00"))
    hour_text(root / "07_a.txt", (1, "06:10:00"))  # same line, other hour: a content of its own
    got = _load(spark, root, main)
    assert [p.rsplit("/", 1)[1] for p in got["files"]["new"]] == ["06_a.txt", "07_a.txt"]
    assert _users(spark, main) == Counter({1: 1}) and got["stray"] == 1
    # another shard has a ledger of its own
    other = new_scratch_path(spark, "main")
    parts.load_parts(spark, [str(root)], 1, 128, other)
    assert list(parts.load_parts(spark, [str(root)], 129, 256, other)["files"]) == ["duplicate", "new"]


def test_a_changed_file_is_refused_before_anything_is_written(spark, tmp_path):
    root = tmp_path / DAY
    main = new_scratch_path(spark, "main")
    hour_text(root / "06_a.txt", (1, "06:10:00"))
    _load(spark, root, main)
    hour_text(root / "06_a.txt", (1, "06:10:00"), (2, "06:10:01"))
    hour_text(root / "06_b.txt", (3, "06:10:00"))
    with pytest.raises(lifecycle.LifecycleError, match="changed"):
        _load(spark, root, main)
    assert _users(spark, main) == Counter({1: 1})


@pytest.mark.parametrize("where", ["before the load", "after the publish"])
def test_a_load_cut_short_is_resumed(spark, tmp_path, monkeypatch, where):
    root = tmp_path / DAY
    main = new_scratch_path(spark, "main")
    hour_text(root / "06_m.txt", (1, "06:10:00"), (2, "06:10:00"))
    real, calls = ledger.record, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("cut short")
        real(*args)

    with monkeypatch.context() as m:
        if where == "after the publish":
            m.setattr(ledger, "record", failing)
        else:
            m.setattr(ingest, "load_flagged", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("cut short")))
        with pytest.raises(RuntimeError, match="cut short"):
            _load(spark, root, main)
    hour_text(root / "06_a.txt", (2, "06:10:00"), (1, "06:10:00"))  # a copy with a lesser name comes meanwhile
    got = _load(spark, root, main)
    assert list(got["files"]) == ["duplicate", "resumed"]
    assert _users(spark, main) == Counter({1: 1, 2: 1})
    assert _load(spark, root, main)["status"] == "nothing to load"


def test_an_hour_loaded_whole_takes_no_parts(spark, tmp_path):
    root = tmp_path / DAY
    main = new_scratch_path(spark, "main")
    hour_text(root / "06_s1.txt", (1, "06:10:00"))
    ingest.load_hour_file(spark, str(root / "06_s1.txt"), 1, 256, main)
    with pytest.raises(lifecycle.LifecycleError, match="whole"):
        _load(spark, root, main)


def test_digest_depends_on_lines_alone(spark):
    def digest(*values):
        rows = spark.createDataFrame([(v, "f") for v in values], "value string, file string").repartition(3)
        return ledger.described(rows.withColumn("src_hour", F.lit(None).cast("timestamp_ntz"))).first()["digest"]

    assert digest("a", "b", "b") == digest("b", "a", "b") != digest("a", "b")
    assert digest("a", "a") != digest("b", "b") and digest("", "a") != digest("a")


def test_stream_takes_a_split_file_over_several_batches(spark, tmp_path):
    root = tmp_path / "landing"
    main = new_scratch_path(spark, "main")

    def run():
        hourly.start(spark, str(root), main, 1, 256, max_files_per_trigger=1, parts=True).awaitTermination(300)

    hour_text(root / DAY / "06_s1.txt", (1, "06:10:00"))
    hour_text(root / DAY / "06_s1_part2.txt", (2, "06:20:00"), (3, "07:00:00"))
    run()
    assert _users(spark, main) == Counter({1: 1, 2: 1})
    hour_text(root / DAY / "06_s1_part3.txt", (4, "06:30:00"))
    hour_text(root / DAY / "06_again.txt", (2, "06:20:00"), (3, "07:00:00"))
    run()
    assert _users(spark, main) == Counter({1: 1, 2: 1, 4: 1})
    states = Counter(r["state"] for r in spark.read.schema(ledger.SCHEMA).parquet(ledger.path_of(main)).collect())
    assert states == Counter({"loaded": 3, "duplicate": 1})
    assert ledger.entries(spark, ledger.path_of(main), "g001_256", [DAY]).count() == 4
