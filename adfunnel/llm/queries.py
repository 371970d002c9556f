"""The contract queries of the thirteen operators and the pipeline: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hilbert, language, licenses, line_dedup, mixing, near_dedup, negatives, quality,
               resampling, secrets, token_counts, toxicity)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = hilbert.hilbert_shards(_documents(spark, sf_dir), n_shards=16)
    return laid.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "curve")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the top directory, the language the one below it."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("_"))
    path = F.concat_ws("/", part("source"), part("lang"), part("doc_id"))
    return licenses.scan_licences(_documents(spark, sf_dir), path)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.BASE],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(_documents(spark, sf_dir))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "p_good")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir)).select("doc_id", "class_id", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                                        {"doc_id": F.col("doc_id")})
    return found.select("doc_id", "contaminated", "item_id", "score", "first_word", "end_word")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    part = lambda c: F.pmod(F.crc32(F.col(c).cast("string")), F.lit(3)) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~part("doc_id"))
    model = toxicity.learn(docs, labels, toxicity.language_model(docs))
    scored = toxicity.score_toxicity(docs, model, {"doc_id": F.col("doc_id"),
                                                   "held_out": F.coalesce(part("doc_id"), F.lit(False))})
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(rows, F.col("vec_id") % 100 == 0, label)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {q.__name__: q for q in (
    op1_hilbert_sharding, op2_line_dedup, op3_license_scan, op4_token_counts, op5_secret_scan, op6_quality_rules,
    op7_near_dedup, op8_language_id, op9_source_mixing, op10_decontamination,
    op11_toxicity, op12_hard_negatives, op13_importance_resampling, pipeline)}
