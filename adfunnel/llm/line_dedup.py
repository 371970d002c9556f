"""Operator 2: line dedup over levelled sorted runs of line hashes.

The store is a set of runs, each a table of ``(line_hash, n_docs)`` bucketed and sorted by the hash,
so that joining runs of one store merges buckets without shuffling them again.  A batch of
documents counts its own lines, merge-anti-joins the hashes that the runs already show in
``min_docs`` documents (nothing more is to be learnt about those) and adds the rest as a run of level 0.
When a level holds ``fanout`` runs they are compacted into one run of the next level, so a store fed by B
batches holds about ``fanout * log(B)`` runs.

A line's key is the line without white space (space, U+0009-U+000D) at both ends, A-Z in lower case; its
hash is the MD5 of the key.  A key of fewer than ``min_chars`` code points is never counted or dropped.

Defined cases: a null or empty text is one empty line; rows of a table are documents, repeated rows
included; a document counts once for a key however often the line is in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, row_key, ship_package, whole_text, written

_WS = WS.encode()


def _keys(text: str) -> list[bytes]:
    """The keys of a text's lines, in UTF-8: bytes.lower() changes A-Z alone."""
    return [line.strip(_WS).lower() for line in text.encode().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _hasher(min_chars: int):
    """A row per document and distinct key hash."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column("text")):
                own = {md5(k).digest() for k in set(_keys(text.as_py())) if _long_enough(k, min_chars)}
                rows += [i] * len(own)
                found += own
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("batch").take(at),
                                              pa.array(found, pa.binary())], names=["key", "batch", "line_hash"])

    return hashes


def _dropper(min_chars: int):
    """The lines of each document without those whose hash is in its ``drop`` list."""
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, listed in zip(batch.column("text"), batch.column("drop")):
                text, listed = text.as_py(), listed.as_py()
                lines = text.split("\n")
                left = lines
                if listed:
                    gone = set(listed)
                    left = [x for x, k in zip(lines, _keys(text))
                            if not _long_enough(k, min_chars) or md5(k).digest() not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append("\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, pa.string())], names=["id", "n_lines", "n_dropped", "kept"])

    return drop


class LineRuns:
    """The levelled runs of one store, kept as bucketed tables of the session's catalog and
    warehouse under names that begin with ``name``."""

    def __init__(self, spark: SparkSession, name: str | None = None, min_docs: int = 10, fanout: int = 3,
                 buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.name = (name or f"line_runs_{uuid.uuid4().hex}").lower()
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[tuple[int, int, str]]:
        """``(level, number, table)`` of the runs, oldest level first."""
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES LIKE '{self.name}_l*'").collect()]
        return sorted((*map(int, n[len(self.name) + 2:].split("_r")), n) for n in names)

    def counts(self, tables: list[str] | None = None) -> DataFrame:
        """Documents per hash over the runs (all of them, or ``tables``), one run merged with the next.

        Not a union and an aggregate: Spark 4.1 takes a union of bucketed tables for one table
        hashed by the bucket key, and where their buckets are read differently the sums come out wrong."""
        tables = [t for *_, t in self.runs()] if tables is None else tables
        if not tables:
            return self.spark.createDataFrame([], "line_hash binary, n_docs long")
        merged = self.spark.table(tables[0])
        for t in tables[1:]:
            more = self.spark.table(t).withColumnRenamed("n_docs", "n_more")
            merged = merged.join(more, "line_hash", "full_outer").select("line_hash", (
                F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_more", F.lit(0))).alias("n_docs"))
        return merged

    def frequent(self) -> DataFrame:
        """The hashes found in at least ``min_docs`` documents."""
        return self.counts().filter(F.col("n_docs") >= self.min_docs).select("line_hash")

    def add(self, counts: DataFrame) -> None:
        """Add a batch's ``(line_hash, n_docs)``: anti-join what is known to be frequent, store the rest."""
        if self.runs():
            counts = counts.join(self.frequent(), "line_hash", "left_anti")
        self._store(counts, 0)
        self._compact()

    def _store(self, counts: DataFrame, level: int) -> None:
        number = 1 + max([n for lv, n, _ in self.runs() if lv == level], default=-1)
        (counts.select("line_hash", "n_docs").repartition(self.buckets, "line_hash")
         .write.bucketBy(self.buckets, "line_hash").sortBy("line_hash").format("parquet")
         .saveAsTable(f"{self.name}_l{level}_r{number}"))

    def _compact(self) -> None:
        level = 0
        while len(full := [t for lv, _, t in self.runs() if lv == level]) >= self.fanout:
            self._store(self.counts(full), level + 1)
            for t in full:
                self.spark.sql(f"DROP TABLE {t}")
            level += 1

    def drop(self) -> None:
        for *_, t in self.runs():
            self.spark.sql(f"DROP TABLE {t}")


def line_hashes(docs: DataFrame, n_batches: int, min_chars: int = 1, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(key, batch, line_hash)``: the distinct line keys of every row; the batch is a hash of id and text."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.unhex(F.md5(row_key(id_col, text_col))).alias("key"), whole_text(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(n_batches)).cast("int").alias("batch"),
    ).mapInArrow(_hasher(min_chars), "key binary, batch int, line_hash binary")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, n_batches: int = 4, fanout: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` per row: the text without the lines whose key is in at
    least ``min_docs`` documents.

    The documents' hashes are made in one scan and go through the store in ``n_batches`` batches; then every
    document drops what the runs show to be frequent.  Only documents that hold a frequent line get a list
    of them, found by a join of line hashes, never of lines.
    """
    spark = docs.sparkSession
    hashed = written(line_hashes(docs, n_batches, min_chars, id_col, text_col), "line-hashes")
    counted = written(hashed.groupBy("batch", "line_hash").agg(F.count(F.lit(1)).alias("n_docs")), "line-batches")
    store = LineRuns(spark, min_docs=min_docs, fanout=fanout)
    for b in range(n_batches):
        store.add(counted.filter(F.col("batch") == b))
    frequent = written(store.frequent(), "line-frequent")
    store.drop()

    lists = (hashed.join(frequent, "line_hash", "left_semi")
             .groupBy("key").agg(F.collect_set("line_hash").alias("drop")).withColumnRenamed("key", "k"))
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"),
                       F.unhex(F.md5(row_key(id_col, text_col))).alias("key"))
    kind = base.schema["id"].dataType.simpleString()
    return (base.join(lists, F.col("key") == F.col("k"), "left").select("id", "text", "drop")
            .mapInArrow(_dropper(min_chars), f"id {kind}, n_lines long, n_dropped long, kept string")
            .withColumnRenamed("id", id_col))
