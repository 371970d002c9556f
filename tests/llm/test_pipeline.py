"""The pipeline: every stage and the whole run, on odd rows, clashing names and an empty table."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from adfunnel.llm import decontaminate, mixing, near_dedup
from adfunnel.session import new_scratch_path

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __copy string, __id long, __times int, row string, `a.b` string"
PASSAGE = " ".join(f"word{i}" for i in range(120))
ODD = [(1, None, "en", "a"), (2, "", "en", "a"), (2, "", "en", "b"), (None, " \n", None, None), (None, " \n", None, "z"), (3, "12 34 !!", "en", "a"),
       (None, PASSAGE, "en", "a"), (None, PASSAGE, "en", "b"), (None, PASSAGE, "en", "b"), (5, PASSAGE + " tail", "en", "c"),
       (6, "Élan vital 日本", "fr", None), (6, "Élan vital 日本", "fr", None), (7, "x " * 5000, "en", "c")]


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    base = [(r["doc_id"] + 1000, r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(*r, 7, f"tag{i}", i, 5, "r", "dot") for i, r in enumerate(ODD + base)]  # __copy tells rows apart
    path = new_scratch_path(spark, "docs")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def test_language_stage_drops_texts_without_a_letter(spark, docs):
    got = P.language_id(spark, docs, SF)
    want = Counter(tuple(r) for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"]))
    assert got.columns == docs.columns and _rows(got) == want


def test_language_stage_sends_the_text_to_the_workers_once(spark, docs):
    plan = P.language_id(spark, docs, SF)._jdf.queryExecution().optimizedPlan().toString()
    fed = re.search(r"MapInArrow predict\((.*?)\)", plan)[1]
    assert len(re.findall(r"#\d+", fed)) == len(docs.columns) + 1  # all columns, and whether the text has a letter


def test_near_dedup_stage_keeps_one_row_of_each_group(spark, docs):
    got, given = _rows(P.near_dedup_stage(spark, docs, SF)), _rows(docs)
    assert not got - given  # rows as they were, none twice
    blank = Counter(k for k in given.elements() if not (k[1] or "").split())
    assert blank == Counter(k for k in got.elements() if not (k[1] or "").split())  # each stays
    found = near_dedup.near_duplicates(docs).collect()
    assert sum(got.values()) == sum(r["kept"] for r in found)
    ids = Counter(k[0] for k in got.elements())
    assert ids == Counter(r["doc_id"] for r in found if r["kept"])
    assert sum(PASSAGE in (k[1] or "") for k in got) == 1  # of exact and near copies one


def test_decontamination_stage_drops_rows_by_their_score(spark, docs):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark, {"tag": F.col("__copy")}).filter("contaminated")
    bad = {r["tag"] for r in found.collect()}
    got = P.decontamination(spark, docs, SF)
    assert got.columns == docs.columns
    assert _rows(got) == Counter(tuple(r) for r in docs.collect() if r["__copy"] not in bad)


@pytest.mark.parametrize("from_files", [True, False])
def test_mix_repeats_each_row_by_itself(spark, docs, from_files):
    given = docs if from_files else docs.unionByName(docs.limit(0))
    got = P.mix(spark, given, SF)
    assert got.columns == docs.columns
    rows = {r["__copy"]: tuple(r) for r in docs.collect()}
    copies = Counter()
    for r in mixing.mix_sources(docs, keep={"tag": F.col("__copy")}).collect():
        copies[rows[r["tag"]]] += r["copies"]
    # which of equal rows (same id, text, source) gets one more is open; their sum is not
    def key(counted):
        out = Counter()
        for k, n in counted.items():
            out[k[0], k[1], k[3]] += n
        return out

    assert key(_rows(got)) == key(+copies)
    assert not set(_rows(got)) - set(rows.values()) and max(_rows(got).values()) <= 3
    sizes, taken, targets = Counter(), Counter(), {}
    for r in mixing.mix_sources(docs).collect():
        sizes[r["source"]] = max(sizes[r["source"]], r["size"])
        taken[r["source"]] += r["size"] * r["copies"]
        targets[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 1.5 * sizes[s] + 1 for s, t in targets.items())
    mine = Counter()
    for k, n in _rows(got).items():
        mine[k[3]] += n * len((k[1] or "").split())
    assert +mine == +taken


def test_sharding_stage_places_every_row(spark, docs):
    got = P.sharding(spark, docs, SF).collect()
    assert len(got) == docs.count()


def test_stages_on_an_empty_table(spark, empty):
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_run(spark, docs, tmp_path):
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    got = P.run(spark, d).collect()
    at = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        at = stage(spark, at, d)
        path = new_scratch_path(spark, "stage")
        at.write.parquet(path)
        at = spark.read.parquet(path)
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in at.select("doc_id").collect()) and got
