"""Operator 10: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Words are read folded: ASCII punctuation separates, A-Z count as a-z.  The score is the best local alignment of
item and text, words against words (match 1, mismatch and gap -1), over the item's number of words: 1 for a verbatim
copy; edited and paraphrased copies lose two for each replaced word.  ``threshold`` or more is contamination.

Seeds lose no such alignment.  Of ``L`` item words a score of ``S`` leaves at most ``E = L - S`` edits, and each of them
breaks at most ``q`` of the item's q-grams, so at least ``S - (q - 1) - (q - 2) E`` of them stay (for q = 2 ``S - 1``,
however many the edits), all within ``E`` diagonals.  An item's n-grams are the longest, up to ``n``, of which one at least
must stay; at the threshold 0.5 these are pairs of words.  They are counted over the whole corpus (documents that
hold them), and up to half of those that must stay are given up, the commonest first, so that common phrases seed
little; the rest are the seeds.  Where as many of them as must still be there stand within ``E`` diagonals, the text
around is aligned with the item.  A passage that leaked everywhere keeps its seeds, and so do edited copies.

The benchmark is read in blocks of about ``block_words`` words (by a hash of the text), so that what each task
holds is bounded however large it grows; every block makes two passes over the corpus without a shuffle of
texts, only the n-gram counts are aggregated.

Defined cases: null and empty texts and items without words match nothing; items of a few words are held to
the same threshold (at 0.5 one word of an item of two is enough); a score from ``threshold`` up is the best there is, a lower one that of the places aligned, 0 if none; of equal scores the smaller item id wins (null last); repeated rows are decided alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import ship_package, whole_text


@dataclass
class Seeds:
    """The n-grams of a block of items: sorted ``values`` (hash), with a slice of entries each."""
    ids: list
    words: list[np.ndarray]
    sizes: list[int]
    values: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray
    least: np.ndarray
    edits: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str], n: int, threshold: float) -> "Seeds":
        """All n-grams of the items; ``least`` of an item's stay in an alignment that reaches the threshold, which has
        at most ``edits`` edits."""
        words: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(ids)
        for _, _, h, of in hashing.word_batches(pa.array(texts, pa.string()), fold=True):
            for i in np.unique(of):
                words[i] = h[of == i]
        rows, sizes = [], set()
        least, edits = np.ones(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i, w in enumerate(words):
            if len(w):
                q, least[i], edits[i] = _gram(len(w), n, threshold)
                sizes.add(q)
                h, first = hashing.windows(w, np.zeros(len(w), np.int64), q)
                rows += [(int(x), i, int(f)) for x, f in zip(h, first)]
        return cls(ids, words, sorted(sizes), *_laid(rows), least, edits)

    def rare(self, frequency: np.ndarray) -> "Seeds":
        """Without the commonest n-grams of each item, up to half of those that must stay."""
        rows, least = [], self.least.copy()
        h, of_entry = (np.repeat(x, np.diff(self.starts)) for x in (self.values, frequency))
        by_item = np.argsort(self.item, kind="stable")
        for mine in np.split(by_item, np.flatnonzero(np.diff(self.item[by_item])) + 1) if len(by_item) else []:
            i = self.item[mine[0]]
            spare, gone = int(self.least[i]) // 2, set()
            grams, first, times = np.unique(h[mine], return_index=True, return_counts=True)
            for g in np.lexsort((grams, -of_entry[mine][first])):
                if times[g] > spare:
                    break
                spare, least[i] = spare - int(times[g]), least[i] - times[g]
                gone.add(grams[g])
            rows += [(int(h[e]), int(i), int(self.place[e])) for e in mine if h[e] not in gone]
        return Seeds(self.ids, self.words, self.sizes, *_laid(rows), least, self.edits)

    def hits(self, words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index into values, place of the first word)`` of the seeds in hashed words."""
        which, where = [], []
        sieve = np.zeros(1 << 20, bool)
        sieve[(self.values & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for k in self.sizes:
            h, first = hashing.windows(words, of, k)
            maybe = np.flatnonzero(sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            h, first = h[maybe], first[maybe]
            at = np.minimum(np.searchsorted(self.values, h), max(len(self.values) - 1, 0))
            there = np.flatnonzero(self.values[at] == h) if len(self.values) else np.zeros(0, np.int64)
            which.append(at[there])
            where.append(first[there])
        if not which:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(which), np.concatenate(where)


def _gram(length: int, n: int, threshold: float) -> tuple[int, int, int]:
    """``(q, least, edits)`` of an item: its seeds' words, how many q-grams must stay, and the most edits."""
    score = max(1, math.ceil(threshold * length - 1e-9))
    edits = max(0, length - score)
    stay = lambda q: score - (q - 1) - max(q - 2, 0) * edits
    q = next(q for q in range(min(n, length), 0, -1) if stay(q) > 0)
    return q, stay(q), edits


def _laid(rows: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
    """``(hash, item, place)`` rows as ``values``, ``starts``, ``item`` and ``place``."""
    rows = sorted(rows)
    h = np.array([r[0] for r in rows], np.uint64)
    values, starts = np.unique(h, return_index=True)
    return (values, np.append(starts, len(h)), np.array([r[1] for r in rows], np.int64),
            np.array([r[2] for r in rows], np.int64))


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment (Smith-Waterman; match 1, mismatch and gap -1): score, and the first and the
    last word of the text in it.  A row of the matrix at a time; gaps in the text by a running maximum."""
    if not len(item) or not len(text):
        return 0, -1, -1
    place = np.arange(len(text))
    row = np.zeros(len(text) + 1, np.int64)
    came = np.arange(len(text) + 1)
    best = (0, -1, -1)
    for w in item:
        step = np.where(text == w, 1, -1)
        diagonal, up = row[:-1] + step, row[1:] - 1
        score = np.maximum(diagonal, up)
        start = np.where(diagonal >= up, np.where(row[:-1] > 0, came[:-1], place), came[1:])
        fresh = score <= 0
        score = np.where(fresh, 0, score)
        # a gap in the text: the best score further left, less its distance
        reach = score + place
        top = np.maximum.accumulate(reach)
        better = top - place > score
        if better.any():
            source = np.maximum.accumulate(np.where(reach == top, place, -1))
            start = np.where(better, start[source], start)
            score = np.where(better, top - place, score)
        row = np.concatenate([[0], score])
        came = np.concatenate([[0], np.where(score > 0, start, place)])
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(came[at + 1]), at)
    return best


def _regions(of: np.ndarray, item: np.ndarray, diagonal: np.ndarray, lengths: np.ndarray, least: np.ndarray,
             edits: np.ndarray):
    """Stretches of text to align: ``(text, item, first, end)`` where ``least`` hits lie within ``edits`` diagonals;
    stretches near each other are one."""
    order = np.lexsort((diagonal, item, of))
    of, item, diagonal = of[order], item[order], diagonal[order]
    end = np.arange(len(of)) + least[item] - 1
    there = np.flatnonzero(end < len(of))
    end = end[there]
    there = there[(of[end] == of[there]) & (item[end] == item[there])
                  & (diagonal[end] - diagonal[there] <= edits[item[there]])]
    of, item, diagonal = of[there], item[there], diagonal[there]
    reach = lengths[item]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > reach[1:])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(of)) - 1 if len(at) else at
    slack = np.maximum(reach[at] // 2, edits[item[at]]) + 2
    return zip(of[at], item[at], diagonal[at] - slack, diagonal[last] + reach[at] + slack)


def _counter(seeds):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = seeds.value
        total = np.zeros(len(s.values), np.int64)
        for batch in batches:
            for _, _, words, of in hashing.word_batches(batch.column("text"), 1 << 18, fold=True):
                which, where = s.hits(words, of)
                if len(which):
                    pairs = np.unique(of[where] * len(s.values) + which)
                    total += np.bincount(pairs % len(s.values), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["g", "n"])

    return count


def _aligner(seeds):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = seeds.value
        lengths = np.array([len(w) for w in s.words], np.int64)
        rank = [(x is None, 0 if x is None else x) for x in s.ids]
        for batch in batches:
            old = [batch.column(c).to_pylist() for c in _BEST]
            # runs of 256 KB: pairs of words hit more often than longer seeds
            for _, _, words, of in hashing.word_batches(pc.fill_null(batch.column("text"), ""), 1 << 18, fold=True):
                which, where = s.hits(words, of)
                if not len(which):
                    continue
                many = s.starts[which + 1] - s.starts[which]
                entry = np.repeat(s.starts[which], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                where = np.repeat(where, many)
                for t, i, lo, hi in _regions(of[where], s.item[entry], where - s.place[entry], lengths,
                                             s.least, s.edits):
                    first, end = np.searchsorted(of, t, side="left"), np.searchsorted(of, t, side="right")
                    lo, hi = max(int(lo), int(first)), min(int(hi), int(end))
                    score, a, b = align(s.words[i], words[lo:hi])
                    share = score / lengths[i]
                    was, id_was = old[1][t], old[0][t]
                    if share > was or share == was and rank[i] < (id_was is None, 0 if id_was is None else id_was):
                        for column, v in zip(old, (s.ids[i], share, lo + a - first, lo + b - first + 1)):
                            column[t] = v
            best = [pa.array(v, kind) for v, kind in zip(old, (pa.int64(), pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("text"), *best, batch.column("row")],
                                             names=["text", *_BEST, "row"])

    return search


#: Name of the text in the result of ``contamination``, which ``keep`` need not name again.
TEXT = "__text"
_BEST = ["item_id", "score", "first_word", "end_word"]


def benchmark_blocks(benchmark: DataFrame, block_words: int, item_col: str, text_col: str):
    """Yields ``(ids, texts)``, in blocks of about ``block_words`` words."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = -(-total // block_words)
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r["id"] is None, r["id"] or 0, r["text"]))
        if rows:
            yield [r["id"] for r in rows], [r["text"] for r in rows]


def contamination(docs: DataFrame, benchmark: DataFrame, keep: dict[str, Column], n: int = 4,
                  threshold: float = 0.5, block_words: int = 200_000, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, the best matching item (``item_id``), its ``score``, the words
    of the text it aligns with (``first_word``, ``end_word``, folded words from 0) and ``contaminated``.

    A block passes the rows through, so no join is needed to add its findings to the documents.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(whole_text(text_col).alias("text"))
    none = F.lit(None).cast("long")
    best = docs.select(F.col(text_col).alias("text"), none.alias("item_id"), F.lit(0.0).alias("score"),
                       none.alias("first_word"), none.alias("end_word"),
                       F.struct(F.lit(1).alias("one"), *[v.alias(f"k{i}") for i, v in enumerate(keep.values())])
                       .alias("row"))
    kind = best.schema
    for ids, items in benchmark_blocks(benchmark, block_words, item_col, item_text):
        every = Seeds.of(ids, items, n, threshold)
        shared = spark.sparkContext.broadcast(every)
        df = {r["g"]: r["n"] for r in texts.mapInArrow(_counter(shared), "g long, n long")
              .groupBy("g").agg(F.sum("n").alias("n")).collect()}  # at most one row per n-gram of the block
        frequency = np.array([df.get(g, 0) for g in range(len(every.values))], np.int64)
        rare = spark.sparkContext.broadcast(every.rare(frequency))
        best = best.mapInArrow(_aligner(rare), kind)
    return best.select(*[F.col(f"row.k{i}").alias(k) for i, k in enumerate(keep)], F.col("text").alias(TEXT), *_BEST,
                       (F.col("score") >= threshold).alias("contaminated"))
