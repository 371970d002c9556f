"""Operator 7: near-duplicate groups by ProbMinHash, banding and verification.

* A text is the multiset of its five-word windows; a shorter one is one window; words are runs of
  ``[^\\x20\\x09-\\x0D]``.  Texts with the same word sequence are exact copies and share one signature.
* ProbMinHash: each window emits a Poisson process of arrivals with its count as rate; every arrival
  goes to one of ``m`` components at random and a component keeps the window of its earliest arrival.
  A window stops once its next arrival comes after the latest of the components' earliest ones.  Two texts agree in a
  component with the probability Jaccard similarity of their weighted windows.
* A link asks for the similarity of the SETS of windows.  So a text in which a window repeats gets a second
  signature, of the same arrivals at rate 1 each, whose components agree with the probability of the sets' Jaccard
  similarity; its bands stand among those of the first.  Where no window repeats the two are the same.
* Banding: ``bands`` groups of ``rows`` components.  The rows of a band are sorted by band value, then by the
  values of the next bands, and each text is paired with the two before it: pairs grow with the texts, not with the square of
  a bucket, and in a large bucket the most similar texts stand together.  A hot bucket is cut over many
  sorted partitions; pairs across a partition border are added from the borders' rows.
* Verification: a pair is linked if the exact Jaccard similarity of its sets of windows is at least
  ``threshold``.  Each text's most frequent partner is verified first and the components of those links formed; of
  the other pairs only those between different components are then left to verify.
* Rest: in a bucket of more texts than the neighbours reach, pairs were left out.  Where the texts of such a
  bucket are still in different components, exact prefix, position and bitmap filters over their windows, rarest
  first, find every pair of texts of different components that can reach ``threshold``; these are verified too.  So no link between
  texts that share a band is lost, and a bucket whose texts are linked costs nothing more.
* The class of a document is the least id in its component.

At a similarity of 0.8 of their window sets, however often windows repeat, a pair of texts shares at least one of 20 bands of 4 with probability 0.99997.

Defined cases: null, empty and blank texts have no words and are copies of nothing, each row a class of its own
with its own id; repeated rows are copies, one of them is kept; a null id takes part, counts as larger than any
other and shows as null.  Distinct texts are told apart by 64-bit hashes of their MD5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import hashing
from .common import WS, WS_CLASS, ship_package, whole_text, written
from .components import components

_NO_ID = 2 ** 63 - 1
#: 64-bit words of the parity bitmaps of ``left_out``.
_WORDS = 8
#: Bytes of text that a worker hashes at a time; its arrays take some 50 times that.
_CHUNK = 1 << 18


def prob_minhash(h: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (``n`` texts by ``m`` components of 64-bit window hashes) of weighted windows.

    Round r handles the r-th arrival of every window that still can change something.
    """
    first = np.full(n * m, np.inf)
    owner = np.zeros(n * m, np.uint64)
    state, time, rate = h.copy(), np.zeros(len(h)), weight.astype(float)
    while len(h):
        state = hashing.mix(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
        time = time - np.log(u) / rate
        slot = of * m + (hashing.mix(state ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        owner[slot[won]] = h[won]
        latest = first.reshape(n, m).max(axis=1)
        go = time < latest[of]
        h, of, state, time, rate = h[go], of[go], state[go], time[go], rate[go]
    return owner.reshape(n, m)


def _signer(m: int, bands: int, k: int):
    rows = m // bands

    def banded(sig: np.ndarray) -> np.ndarray:
        band = np.zeros((len(sig), bands), np.uint64)
        for r in range(rows):
            band = hashing.mix(band + sig[:, r::rows][:, :bands] + np.uint64(r + 1))
        return band.view(np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the bands of the counts, then those of the sets where they are others
            values = np.zeros((batch.num_rows, 2 * bands), np.int64)
            has = np.zeros((batch.num_rows, 2), bool)
            for at, end, words, of in hashing.word_batches(batch.column("text"), _CHUNK):
                if not len(words):
                    continue
                present, local = np.unique(of, return_inverse=True)
                h, t, count = hashing.counted(*hashing.shingles(words, local, k))
                values[present, :bands], has[present, 0] = banded(prob_minhash(h, t, count, len(present), m)), True
                again = np.unique(t[count > 1])
                if len(again):
                    some = np.flatnonzero(np.isin(t, again))
                    once = prob_minhash(h[some], np.searchsorted(again, t[some]), np.ones(len(some)), len(again), m)
                    values[present[again], bands:], has[present[again], 1] = banded(once), True
            offsets = np.concatenate([[0], np.cumsum(has.sum(axis=1) * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.repeat(has, bands, axis=1)]))
            yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("copy"), lists],
                                             names=["ord", "copy", "bands"])

    return sign


def _window_sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sizes = [], np.zeros(batch.num_rows, np.int64)
            for at, end, words, of in hashing.word_batches(batch.column("text"), _CHUNK):
                h, t, _ = hashing.counted(*hashing.shingles(words, of, k)) if len(words) else (words, of, None)
                parts.append(h.view(np.int64))
                sizes += np.bincount(t, minlength=batch.num_rows)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ord"), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["ord", "windows"])

    return sets


def _neighbours(back: int):
    """Pairs of each row with the ``back`` rows before it in the same bucket (``edge`` 0); the rows of larger
    buckets (2); per partition also its first and last ``back + 1`` rows (-1 and 1, numbered), to join the borders."""
    span = back + 1

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_b, kept_v, kept_i = (np.zeros(0, t) for t in (np.int32, np.int64, np.int64))
        head: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            b = np.concatenate([kept_b, batch.column("band").to_numpy()])
            v = np.concatenate([kept_v, batch.column("value").to_numpy()])
            i = np.concatenate([kept_i, batch.column("node").to_numpy()])
            old = len(kept_b)
            if len(head) < span:
                first = slice(old, old + span - len(head))
                head += list(zip(b[first].tolist(), v[first].tolist(), i[first].tolist()))
            xs, ys = [], []
            for step in range(1, back + 1):
                at = np.arange(max(old, step), len(b))
                same = at[(b[at] == b[at - step]) & (v[at] == v[at - step])]
                xs.append(i[same - step])
                ys.append(i[same])
            x, y = np.concatenate(xs), np.concatenate(ys)
            far = np.arange(max(old, span), len(b))
            far = far[(b[far] == b[far - span]) & (v[far] == v[far - span])]
            many = np.unique((far[:, None] - np.arange(span + 1)).reshape(-1))
            if len(many):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(many), 2, np.int32)), pa.array(b[many]), pa.array(v[many]),
                     pa.array(i[many]), pa.array(np.zeros(len(many), np.int64))], names=_PAIR)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(x), np.int32)), pa.array(np.zeros(len(x), np.int32)),
                 pa.array(np.zeros(len(x), np.int64)), pa.array(x), pa.array(y)], names=_PAIR)
            kept_b, kept_v, kept_i = b[-span:], v[-span:], i[-span:]
        ends = [(-1, *r) for r in head] + [(1, *r) for r in zip(kept_b.tolist(), kept_v.tolist(), kept_i.tolist())]
        if ends:
            edge, band, value, node = (list(c) for c in zip(*ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(edge, pa.int32()), pa.array(band, pa.int32()), pa.array(value, pa.int64()),
                 pa.array(node, pa.int64()), pa.array(range(len(ends)), pa.int64())], names=_PAIR)

    return pair


_PAIR = ["edge", "band", "value", "a", "b"]


def candidate_pairs(signatures: DataFrame, bands: int, back: int = 2) -> tuple[DataFrame, DataFrame]:
    """``a < b, n``: the pairs of neighbours in the sorted bands, and in how many bands they are; and
    ``band, value, node`` of the buckets in which not all pairs are neighbours."""
    band = F.pmod("at", F.lit(bands)).cast("int")
    after = lambda i: F.col("bands")[F.col("at") - band + F.pmod(F.col("at") + i, F.lit(bands))]
    # a band in which both signatures of a text agree stands once
    laid = (signatures.select("node", "bands", F.posexplode("bands").alias("at", "value"))
            .filter((F.col("at") < bands) | (F.col("value") != F.col("bands")[band]))
            .select(band.alias("band"), "value", after(1).alias("next"), after(2).alias("then"), "node"))
    keys = ["band", "value", "next", "then", "node"]
    found = written(laid.repartitionByRange(*keys).sortWithinPartitions(*keys).select("band", "value", "node")
                    .mapInArrow(_neighbours(back), "edge int, band int, value long, a long, b long")
                    .withColumn("pid", F.spark_partition_id()), "near-pairs")
    # borders: 2 * (back + 1) rows per partition, in the order of partitions; pairs reach over a border only
    ends = found.filter("edge != 0").select("pid", "edge", "band", "value", F.col("a").alias("node"),
                                            F.col("b").alias("no"))
    order = W.partitionBy("band", "value").orderBy("pid", "no")
    ends = ends.dropDuplicates(["band", "value", "node", "pid"])
    crowded = found.filter("edge = 2").select("band", "value", F.col("a").alias("node")).unionByName(
        ends.select("band", "value", "node")).distinct()
    over = [ends.select("pid", "band", "value", F.lag("node", s).over(order).alias("x"), F.col("node").alias("y"),
                        F.lag("pid", s).over(order).alias("from"))
            .filter((F.col("from") < F.col("pid")) & (F.col("x") != F.col("y"))).select("x", "y")
            for s in range(1, back + 1)]
    both = found.filter("edge = 0").select(F.col("a").alias("x"), F.col("b").alias("y"))
    for o in over:
        both = both.unionByName(o)
    pairs = (both.filter("x != y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
             .agg(F.count(F.lit(1)).alias("n")))
    n = {r["edge"]: r["n"] for r in found.groupBy(F.abs("edge").alias("edge")).agg(F.count(F.lit(1)).alias("n")).collect()}
    inner, border, large = (n.get(edge, 0) for edge in (0, 1, 2))
    return (written(pairs, "near-candidates", inner + back * border), written(crowded, "near-crowded", large + border))


def left_out(crowded: DataFrame, roots: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: pairs of texts of different components, out of buckets that hold several components, whose
    window sets may reach ``threshold``.

    Windows that occur in one component alone cannot be common to such a pair; the others, rarest first, are a
    text's usable windows.  Three exact filters for ``c`` common windows, all applied as the join meets a pair:

    * prefix: ``c >= t |x|``, so the first ``usable - ceil(t |x|) + 1`` usable windows of each share one;
    * position: where the first shared one stands, ``c`` is at most the lesser number of usable windows from there on;
    * bitmap: the parities of the usable windows in ``64 * _WORDS`` classes differ between two texts in at most as
      many classes as there are windows that only one of them has.
    """
    placed = crowded.join(roots, "node", "left").select("band", "value", "node",
                                                        F.coalesce("root", "node").alias("root"))
    mixed = (placed.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .filter("lo != hi").select("band", "value"))
    nodes = placed.join(mixed, ["band", "value"]).select("node", "root").distinct()
    each = written(sets.join(nodes, "node").select("node", "root", F.size("windows").alias("size"),
                                                   F.explode("windows").alias("w")), "near-mixed")
    shared = (each.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
              .filter("lo != hi").select("w", "n"))
    of = W.partitionBy("node")
    bit = "shiftleft(1L, cast(shiftright(w, 8) & 63 as int))"
    parity = {f"x{i}": F.coalesce(F.expr(f"bit_xor(CASE WHEN pmod(w, {_WORDS}) = {i} THEN {bit} END)").over(of), F.lit(0))
              for i in range(_WORDS)}
    ranked = each.join(shared, "w").withColumns(
        {"left": F.count(F.lit(1)).over(of) - F.row_number().over(of.orderBy("n", "w")) + 1,
         "usable": F.count(F.lit(1)).over(of)} | parity)
    cols = ["node", "root", "size", "left", "usable", *parity]
    prefix = written(ranked.filter(F.col("left") >= F.ceil(F.col("size") * threshold - 1e-9)).select("w", *cols),
                     "near-prefix")
    a, b = (prefix.select("w", *[F.col(c).alias(c + s) for c in cols]) for s in ("_a", "_b"))
    # c (1 + t) >= t (|a| + |b|)
    least = threshold * (F.col("size_a") + F.col("size_b")) - 1e-9
    differ = sum((F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in parity), F.lit(0))
    return (a.join(b, [a.w == b.w, F.col("root_a") < F.col("root_b"),
                       F.least("left_a", "left_b") * (1 + threshold) >= least,
                       (F.col("usable_a") + F.col("usable_b") - differ) / 2 * (1 + threshold) >= least])
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose window sets have a Jaccard similarity of ``threshold`` or more."""
    left = sets.select(F.col("node").alias("a"), F.col("windows").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("windows").alias("wb"))
    # c / (|a| + |b| - c) >= t, solved for the common windows c
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .filter(F.size(F.array_intersect("wa", "wb")) * (1 + threshold)
                    >= threshold * (F.size("wa") + F.size("wb")) - 1e-9).select("a", "b"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = 5, m: int = 80, bands: int = 20,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``copy`` (MD5 of the word sequence), ``class_id`` (least id of the
    group) and ``kept`` (true for one row of each group)."""
    ship_package(docs.sparkSession)
    norm = F.regexp_replace(F.btrim(whole_text(text_col), F.lit(WS)), WS_CLASS + "+", " ")
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    base = docs.select(order.alias("ord"), F.md5(norm).alias("copy"), whole_text(text_col).alias("text"))
    signed = written(base.mapInArrow(_signer(m, bands, k), "ord long, copy string, bands array<long>")
                     .withColumn("row", F.monotonically_increasing_id()), "near-signed")
    # exact copies: the row with the least id speaks for them
    texts = written(signed.filter(F.size("bands") > 0).groupBy("copy")
                    .agg(F.min("ord").alias("ord"), F.first("bands").alias("bands"))
                    .withColumn("node", F.xxhash64("copy")), "near-texts", signed.count())
    pairs, crowded = candidate_pairs(texts, bands)

    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    speakers = texts.join(asked, "node", "left_semi").select("node", "copy", "ord")
    sets = written(base.join(speakers, ["copy", "ord"]).select(F.col("node").alias("ord"), "text")
                   .mapInArrow(_window_sets(k), "ord long, windows array<long>")
                   .select(F.col("ord").alias("node"), "windows"), "near-sets")
    # rows repeated with the same id and text gave the same set more than once
    if texts.join(asked, "node", "left_semi").count() != sets.count():
        sets = written(sets.groupBy("node").agg(F.first("windows").alias("windows")), "near-sets")

    ends = pairs.select(F.col("a").alias("node"), "a", "b", "n").unionByName(
        pairs.select(F.col("b").alias("node"), "a", "b", "n"))
    best = (ends.groupBy("node").agg(F.max(F.struct("n", "a", "b")).alias("p")).select("p.a", "p.b").distinct())
    best = written(best, "near-best", texts.count())
    links = written(verified(best, sets, threshold), "near-links")
    roots = components(links)
    rest = (pairs.join(best, ["a", "b"], "left_anti")
            .join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
            .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
            .filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
    more = written(verified(rest, sets, threshold), "near-links")
    # the star of each component stands for its links
    star = lambda r: r.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(star(roots).unionByName(more))
    last = written(verified(left_out(crowded, roots, sets, threshold), sets, threshold), "near-links")
    if not last.isEmpty():
        roots = components(star(roots).unionByName(last))

    # a row's class: the component of its text, the text itself, or for a blank text the row alone
    own = F.when(F.size("bands") > 0, F.xxhash64("copy"))
    rows = (signed.select("ord", "copy", "row", own.alias("node"))
            .join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
            .select("ord", "copy", "row", F.coalesce("root", "node").alias("class")))
    rows = written(rows, "near-rows")
    firsts = (rows.filter("class is not null").groupBy(F.col("class").alias("c"))
              .agg(F.min(F.struct("ord", "row")).alias("f")))
    real = lambda x: F.when(x != _NO_ID, x)
    return (rows.join(firsts, F.col("class") == F.col("c"), "left")
            .select(real(F.col("ord")).alias(id_col), "copy",
                    real(F.coalesce("f.ord", "ord")).alias("class_id"),
                    F.coalesce(F.col("f.row") == F.col("row"), F.lit(True)).alias("kept")))
