"""The corpus pipeline: documents to a cleaned, mixed and sharded training set.

Five stages, each one operator of ``adfunnel.llm`` applied to all that the stage before kept.  A stage
takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``docs``.

Defined cases, for any stage: an empty table stays empty; null ids, texts or other columns and extra columns
pass through, whatever their names; rows repeated with the same id and text are decided alike where a stage keeps or
drops, near dedup keeps one of them, and the mix takes each row by itself, so equal rows under two sources
stay with their sources.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfunnel.llm import decontaminate, hilbert, language, mixing, near_dedup
from adfunnel.llm.common import WS, WS_CLASS, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no language; the languages are learnt from the labelled rows.

    The operator gives every text with a letter a language, so what this stage rejects is texts without one."""
    rest = [c for c in docs.columns if c != "text"]
    found = language.identify(docs, language.learn(docs), {f"c{i}": F.col(_quoted(c)) for i, c in enumerate(rest)},
                              text_as="text")
    at = {c: f"c{i}" for i, c in enumerate(rest)} | {"text": "text"}
    return found.filter(F.col("lang_pred") != "und").select(*[F.col(at[c]).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: that of the least id, of rows with that id and the same words
    the first by its columns.  Texts without words are groups of their own and stay, each row as it is."""
    copy = F.md5(F.regexp_replace(F.btrim(F.coalesce("text", F.lit("")), F.lit(WS)), WS_CLASS + "+", " "))
    found = near_dedup.near_duplicates(docs).groupBy("doc_id", "copy").agg(
        F.count(F.when(F.col("kept"), 1)).alias("kept"), F.count(F.lit(1)).alias("rows"))
    found = written(found.filter("kept > 0"), "kept")
    keys = {"doc_id": F.col("doc_id"), "copy": copy}
    whole = _unpacked(_matched(docs, keys, found.filter("kept = rows")), docs.columns)
    repeated = found.filter("kept < rows")
    if repeated.isEmpty():
        return whole
    some = _matched(docs, keys, repeated, {"copy": copy})
    row = F.struct(*[F.col(f"row.c{i}").alias(f"c{i}") for i in range(len(docs.columns))])
    one = (some.groupBy(F.col("row.id").alias("id"), F.col("row.copy").alias("copy"))
           .agg(F.min_by(row, F.to_json(row)).alias("row")))
    return whole.unionByName(_unpacked(one, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, verbatim or edited."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rest = [c for c in docs.columns if c != "text"]
    found = decontaminate.contamination(docs, benchmark, {f"c{i}": F.col(_quoted(c)) for i, c in enumerate(rest)})
    at = {c: f"c{i}" for i, c in enumerate(rest)} | {"text": decontaminate.TEXT}
    return found.filter(~F.col("contaminated")).select(*[F.col(at[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each row as often as the mix takes it (0 to 3 times)."""
    try:
        at = docs.metadataColumn("_metadata")  # docs are files: a row has a place
        docs.select(at["row_index"])
    except AnalysisException:
        docs = written(docs, "to-mix")
        at = docs.metadataColumn("_metadata")
    place = {"file": F.xxhash64(at["file_path"]), "line": at["row_index"]}
    taken = mixing.mix_sources(docs, keep=place).select("file", "line", "copies").filter("copies > 0")
    found = _matched(docs, place, written(taken, "taken"), also="copies")
    return _unpacked(found.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mix."""
    return hilbert.hilbert_shards(docs)


def _matched(docs: DataFrame, keys: dict[str, Column], wanted: DataFrame, kept: dict[str, Column] | None = None,
             also: str | None = None) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` stand in ``wanted`` (each key once), packed as ``row`` with fields ``c0, c1, ...``, so that no column of
    ``docs`` can clash with one of the join; ``id`` and ``kept`` beside them, ``also``: a column of ``wanted``."""
    fields = [F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    more = [F.col("doc_id").alias("id"), *[v.alias(k) for k, v in kept.items()]] if kept else []
    packed = docs.select(F.struct(*fields, *more).alias("row"), *[v.alias(f"key_{k}") for k, v in keys.items()])
    same = None
    for k in keys:
        term = F.col(f"key_{k}").eqNullSafe(F.col(k))
        same = term if same is None else same & term
    return packed.join(wanted, same).select("row", *([also] if also else []))


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


STAGES = [("language ID", language_id), ("MinHash near-dedup", near_dedup_stage),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mix),
          ("sharding", sharding)]

#: No SQL: the stages learn, hash and align; ``tests/llm/test_pipeline.py`` holds them and ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
