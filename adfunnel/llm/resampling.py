"""Operator 13: importance resampling towards a target distribution.

Features are all runs of 1 to ``max_n`` consecutive words, hashed into buckets.  Words come from the UTF-8
bytes: one 256-byte table lower-cases A-Z and blanks every other ASCII byte that is neither letter nor digit,
``bytes.split`` cuts, and ``zlib.crc32`` extends an n-gram by using the shorter one's value as its seed.
One pass counts the buckets (a ``Counter`` for each task, at most a row per bucket and task is shuffled), a
second weighs each document by the floored mean of its buckets' log ratios, and Gumbel noise that depends on
seed and id alone turns the weights into a draw without replacement: the highest scores.

The driver holds one count per bucket.  Ranks are a distributed prefix sum over narrow rows.  Texts are read
in blocks of about a MiB, so a long text costs no more memory than a short one.

Defined cases: a null or wordless text has no features, weight 0 and is never drawn below ``min_words`` words
(at 0 it competes with its noise); a null id draws its noise as the word ``null`` and comes last among ties;
rows repeated with one id and text have equal scores and ranks of their own; an empty table gives an empty
result, an empty target gains from unseen buckets alone; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered_totals, ship_package, written

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters, blanks the rest.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, block by block; a word is never cut."""
    data, at = text.translate(TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def ngram_crcs(text: bytes, max_n: int) -> Iterator[tuple[int, list[int]]]:
    """``(n, crc32 of every run of n words)``, block by block."""
    last: list[int | None] = [None] * max_n  # of each length, the run that ends with the last word so far
    for words in word_blocks(text):
        level = list(map(zlib.crc32, words))
        for n in range(max_n):
            yield n + 1, level
            if n + 1 == max_n:
                break
            seeds = level[:-1] if last[n] is None else [last[n], *level[:-1]]
            last[n] = level[-1] if level else last[n]
            level = list(map(zlib.crc32, words[len(words) - len(seeds):], map(zlib.crc32, repeat(b" "), seeds)))


def _texts(column: pa.Array) -> Iterator[bytes]:
    column = column.cast(pa.binary())
    for at in range(0, len(column), 64):
        for v in column.slice(at, 64).to_pylist():
            yield v or b""


def _buckets(crcs: list[int], buckets: int) -> np.ndarray:
    return np.array(crcs, np.uint32) % np.uint32(buckets)


def _counter(max_n: int, buckets: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        held: list[int] = []

        def add() -> None:
            n = np.bincount(_buckets(held, buckets), minlength=0)
            seen.update({int(b): int(n[b]) for b in np.flatnonzero(n)})
            held.clear()

        for batch in batches:
            for text in _texts(batch.column(0)):
                for _, crcs in ngram_crcs(text, max_n):
                    held.extend(crcs)
                    if len(held) >= 1 << 20:
                        add()
        add()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())],
                                         names=["bucket", "n"])

    return count


def bucket_counts(docs: DataFrame, max_n: int = 2, buckets: int = 10000, text_col: str = "text") -> Counter[int]:
    """How many features of all texts fall into each bucket."""
    ship_package(docs.sparkSession)
    each = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _counter(max_n, buckets), "bucket int, n long")
    return Counter({r["bucket"]: r["n"] for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect()})


def gains(source: Counter[int], target: Counter[int], buckets: int) -> list[int]:
    """For each bucket, the floor of 1000 times the log of its smoothed share in the target over that in the source."""
    s_all, t_all = sum(source.values()), sum(target.values())
    return [math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]


def _weigher(gain: list[int], max_n: int) -> Callable:
    buckets, table = len(gain), np.array(gain, np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in _texts(batch.column(0)):
                words = found = total = 0
                for n, crcs in ngram_crcs(text, max_n):
                    words += len(crcs) if n == 1 else 0
                    found += len(crcs)
                    total += int(table[_buckets(crcs, buckets)].sum())
                n_words.append(words)
                n_features.append(found)
                weights.append(total // found if found else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return weigh


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the seed and the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, max_n: int = 2,
             buckets: int = 10000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``: of the documents with
    ``min_words`` words or more, ``percent`` of a hundred (rounded down) are drawn and ranked from 1."""
    gain = gains(bucket_counts(docs, max_n, buckets, text_col), bucket_counts(target, max_n, buckets, target_col), buckets)
    fed = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"))
    kind = fed.schema["doc_id"].dataType.simpleString()
    weighed = fed.mapInArrow(_weigher(gain, max_n), f"doc_id {kind}, n_words long, n_features long, weight long")
    # the salt parts rows that share score and id, so that no range holds more than its share
    scored = written(weighed.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "salt": F.rand(seed)}),
                     "scored")
    able = F.col("n_words") >= min_words
    n_drawn = scored.filter(able).count() * percent // 100
    keyed = scored.withColumns({"unable": (~able).cast("int"), "down": -F.col("score")})
    placed = ordered_totals(keyed, ["unable", "down", "doc_id", "salt"], {"earlier": F.lit(1).cast("long")}, "ranked")
    rank = F.when((F.col("unable") == 0) & (F.col("earlier") < n_drawn), F.col("earlier") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
