"""Operator 12: hard negatives for contrastive training, by a secondary-sort shuffle.

For an anchor, its first ``n_pos`` other rows of the same label are its positives; each positive with score p
opens the window of scores ``low * p <= 100 * s <= high * p``, and the first ``n_neg`` rows of another label in it are
its hard negatives.  Order: score down, then id.  Scores are integer inner products.

Pairs travel under the packed key (anchor, descending score, positives first, id): hash-partitioned by anchor,
sorted inside the partitions (``repartition`` and ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``, which sorts in the JVM and spills).  An iterator reads them in that order;
a positive opens its window, a negative is emitted for every open window that holds it, and nothing of
an anchor is kept but its at most ``n_pos`` windows.

Only pairs that can matter are shuffled: each task scores its rows against a block of anchors and sends, for an
anchor, its ``n_pos`` best of the same label (first round), and then, once the windows are known, its ``n_neg`` best of each
window (second round).  Every row that is among the first overall is among the first of its task, so
nothing is lost.  Blocks hold at most ``block_bytes`` of anchor vectors, which is what the driver and a broadcast hold;
vectors are never shuffled.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; no row pairs
with a row of its own id; rows repeated under one id are candidates each, but an anchor id stands once
(its least label, then vector); vectors of different lengths do not pair; a score beyond 64 bits is held at the
end of their range; a positive of negative score has an empty window, one of score 0 a window of scores 0; an empty table or one without
anchors gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered_totals, ship_package, written

LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1
POSITIVE, NEGATIVE = 0, 1
PAIR = "anchor_id long, down long, kind int, id long"
FOUND = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def quantised(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = 256) -> DataFrame:
    """``id, label, q`` of the rows that take part; ``q``: floors of ``scale`` times the components."""
    real = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("x"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", real))
            .select("id", "label", F.transform("x", lambda v: F.floor(v * scale)).alias("q")))


def _matrix(vectors: pa.Array, length: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), length)


def inner_products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where no sum can pass 2^53, else in Python integers."""
    most = float(np.abs(rows.astype(float)).max(initial=0)) * float(np.abs(anchors.astype(float)).max(initial=0))
    if most * max(1, rows.shape[1]) < 2.0 ** 53:
        return (rows.astype(float) @ anchors.T.astype(float)).astype(np.int64)
    exact = rows.astype(object) @ anchors.T.astype(object)
    return np.array([[max(LEAST, min(MOST, int(v))) for v in r] for r in exact], np.int64).reshape(exact.shape)


class Best:
    """For each of ``n`` lists the first ``k`` entries by score down, id and place."""

    def __init__(self, floors: np.ndarray, k: int):
        n = len(floors)
        self.k, self.floors = k, floors.copy()  # what an entry must reach
        self.list, self.score, self.id, self.at = (np.zeros(0, np.int64) for _ in range(4))
        self.n = n

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        lists, scores, ids, at = (np.concatenate(x) for x in (
            (self.list, lists), (self.score, scores), (self.id, ids), (self.at, at)))
        order = np.lexsort((at, ids, -scores, lists))
        lists = lists[order]
        rank = np.arange(len(lists)) - np.searchsorted(lists, lists)
        kept = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.list, self.score, self.id, self.at = lists[rank < self.k], scores[kept], ids[kept], at[kept]
        self.floors[lists[rank == self.k - 1]] = scores[full]

    def offer(self, lists: np.ndarray, scores: np.ndarray, able: np.ndarray, ids: np.ndarray, first: int) -> None:
        """``scores``: a row per candidate, a column per entry of ``lists``; ``able``: which may enter."""
        able = able & (scores >= self.floors[lists])
        if len(scores) > self.k:  # of many candidates those that reach the k-th best score, with all ties
            held = np.where(able, scores, LEAST - 1)
            able &= held >= np.partition(held, len(scores) - self.k, axis=0)[len(scores) - self.k]
        r, c = np.nonzero(able)
        if len(r):
            self.add(lists[c], scores[r, c], ids[r], first + r)


#: Anchors of one length: ids, labels, vectors and, once known, the bounds of their windows (least and most score).
Block = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _scorer(block, kind: int, k: int, cells: int = 1 << 21) -> Callable:
    """Per task: the best ``k`` rows of each anchor (``POSITIVE``) or of each anchor's windows (``NEGATIVE``)."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Block = block.value
        best = {n: Best(np.full(len(a[0]), LEAST, np.int64) if kind == POSITIVE else a[3].reshape(-1), k)
                for n, a in anchors.items()}
        seen = 0
        for batch in batches:
            lengths = np.asarray(batch.column("q").value_lengths())
            for n in np.unique(lengths):
                if n not in anchors:
                    continue
                rows = np.flatnonzero(lengths == n)
                a_ids, a_labels, a_vectors, _, most = anchors[n]
                step = max(64, cells // len(a_ids))
                for at in range(0, len(rows), step):
                    part = batch.take(pa.array(rows[at:at + step]))
                    ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
                    s = inner_products(_matrix(part.column("q"), int(n)), a_vectors)
                    same = labels[:, None] == a_labels
                    if kind == POSITIVE:
                        best[n].offer(np.arange(len(a_ids)), s, same & (ids[:, None] != a_ids), ids, seen)
                    else:
                        for j in range(most.shape[1]):
                            best[n].offer(np.arange(len(a_ids)) * most.shape[1] + j, s, ~same & (s <= most[:, j]), ids, seen)
                    seen += len(ids)
        for n, b in best.items():
            of = b.list // (1 if kind == POSITIVE else anchors[n][4].shape[1])
            pairs = np.unique(np.stack([of, b.score, b.id, b.at]), axis=1) if len(of) else np.zeros((4, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[n][0][pairs[0]]), pa.array(-pairs[1]),
                 pa.array(np.full(pairs.shape[1], kind, np.int32)), pa.array(pairs[2])],
                names=["anchor_id", "down", "kind", "id"])

    return score


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the most integer s with ``low * score <= 100 * s <= high * score``; least > most: none."""
    return max(LEAST, -(-low * score // 100)), min(MOST, high * score // 100)


def _stream(n_pos: int, n_neg: int, low: int, high: int, emit: int) -> Callable:
    """Reads pairs by packed key; ``emit`` says whether positives or the negatives of their windows come out."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows, out = None, [], []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(columns)],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        for batch in batches:
            for a, down, kind, i in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "down", "kind", "id"))):
                if a != anchor:
                    anchor, windows = a, []
                if kind == POSITIVE:
                    if len(windows) < n_pos:
                        windows.append([i, -down, *bounds(-down, low, high), 0])
                        if emit == POSITIVE:
                            out.append((a, i, len(windows), None, -down, None))
                elif emit == NEGATIVE:
                    for w in windows:
                        if w[4] < n_neg and w[2] <= -down <= w[3]:
                            w[4] += 1
                            out.append((a, w[0], w[4], i, w[1], -down))
                if len(out) >= 10000:
                    yield flushed()
        yield flushed()

    return read


def _sorted_stream(pairs: DataFrame, *how) -> DataFrame:
    key = ["anchor_id", "down", "kind", "id"]
    return pairs.repartition("anchor_id").sortWithinPartitions(*key).mapInArrow(_stream(*how), FOUND)


def mine_negatives(rows: DataFrame, is_anchor: Column, label: Column, n_pos: int = 5, n_neg: int = 10, low: int = 30,
                   high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding",
                   block_bytes: int = 16 << 20) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor and positive
    its hard negatives, ranked from 1.  ``is_anchor`` reads the columns of ``rows``."""
    spark = rows.sparkSession
    ship_package(spark)
    flagged = rows.withColumns({c: v for c, v in (("__anchor", is_anchor), ("__label", label))})
    table = written(quantised(flagged, id_col, vector_col, F.col("__label")), "vectors")
    chosen = quantised(flagged.filter("__anchor"), id_col, vector_col, F.col("__label"))
    chosen = chosen.groupBy("id").agg(F.min(F.struct("label", "q")).alias("v")).select("id", "v.label", "v.q")
    weight = (F.size("q") + 2 + 2 * n_pos) * 8
    placed = ordered_totals(chosen, ["id"], {"before": weight.cast("long")}, "anchors") \
        .withColumn("block", F.floor(F.col("before") / block_bytes))
    placed = written(placed.select("id", "label", "q", "block"), "anchor-blocks")
    parts = [r[0] for r in placed.select("block").distinct().orderBy("block").collect()]
    found = None
    for b in parts:
        mined = written(_mine_block(table, placed.filter(F.col("block") == b), n_pos, n_neg, low, high), "mined")
        found = mined if found is None else found.unionByName(mined)
    return spark.createDataFrame([], FOUND) if found is None else found


def _mine_block(table: DataFrame, anchors: DataFrame, n_pos: int, n_neg: int, low: int, high: int) -> DataFrame:
    sc = table.sparkSession.sparkContext
    got = anchors.select("id", "label", "q").toArrow().combine_chunks()
    lengths = np.asarray(pa.compute.list_value_length(got.column("q")))
    block: Block = {}
    for n in np.unique(lengths):
        part = got.take(pa.array(np.flatnonzero(lengths == n)))
        none = np.full((part.num_rows, n_pos), MOST, np.int64), np.full((part.num_rows, n_pos), LEAST, np.int64)
        block[int(n)] = (part.column("id").to_numpy(), part.column("label").to_numpy(),
                         _matrix(part.column("q").combine_chunks(), int(n)), *none)
    first = table.mapInArrow(_scorer(sc.broadcast(block), POSITIVE, n_pos), PAIR)
    positives = written(_sorted_stream(first, n_pos, n_neg, low, high, POSITIVE), "positives")
    opened = {a: {} for a in got.column("id").to_pylist()}
    for r in positives.select("anchor_id", "rank", "positive_score").collect():  # at most n_pos per anchor of the block
        opened[r[0]][r[1]] = bounds(r[2], low, high)
    for ids, _, _, least, most in block.values():
        for k, i in enumerate(ids.tolist()):
            for rank, (a, b) in opened[i].items():
                least[k, rank - 1], most[k, rank - 1] = (a, b) if a <= b else (MOST, LEAST)
    second = table.mapInArrow(_scorer(sc.broadcast(block), NEGATIVE, n_neg), PAIR)
    known = positives.select("anchor_id", (-F.col("positive_score")).alias("down"), F.lit(POSITIVE).alias("kind"),
                             F.col("positive_id").alias("id"))
    return _sorted_stream(second.unionByName(known), n_pos, n_neg, low, high, NEGATIVE)
