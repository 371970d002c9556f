"""Operator 1: sharding along a Hilbert curve over document metadata.

Every dimension is quantised into ``2**bits`` cells at the quantiles of the whole table (strings by their
whole values), the cells
give each row a place on a Hilbert curve, the rows are sorted along it and the order is cut into
runs of near equal bytes.  Neighbours on the curve are close in every dimension, so a shard (and each
file cut from it) covers a small box of the metadata space and min/max statistics prune files on any
of the dimensions.

Equal texts take the place of their first copy (smallest id) on the curve, so they are neighbours, and
a cut that would fall into such a group moves to the group's nearer end; only a group of more than
``whole_share`` of a shard is cut inside, because it would upset the sizes.

Defined cases: a null text has size 1 (0 bytes plus 1); null metadata count as the lowest cell;
repeated rows are separate rows; an empty table gives no rows; with fewer rows than shards some
shards stay empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ordered_totals, ship_package, written


def _is_number(df: DataFrame, dim: str) -> bool:
    return dim == "size" or isinstance(df.schema[dim].dataType, (T.NumericType, T.BooleanType))


def _string_edges(docs: DataFrame, dim: str, steps: int) -> list[str]:
    """The values, whole, at the ``steps`` quantiles of a column of strings: the distinct values are counted and
    their counts summed up in order, and only the values on which a quantile falls reach the driver."""
    counts = (docs.select(F.col(dim).cast("string").alias("v")).filter(F.col("v").isNotNull())
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    laid = written(ordered_totals(counts, ["v"], {"before": F.col("n")}, "hilbert-values"), "hilbert-quantiles")
    total = laid.agg(F.sum("n")).first()[0] or 0
    want = sorted({-(-total * i // (steps + 1)) for i in range(1, steps + 1)} - {0})
    if not want:
        return []
    hit = F.exists(F.array(*[F.lit(w) for w in want]),
                   lambda w: (w > F.col("before")) & (w <= F.col("before") + F.col("n")))
    return [r["v"] for r in laid.filter(hit).orderBy("v").select("v").collect()]  # at most ``steps``


def _code(docs: DataFrame, dim: str, edges: list[str] | None) -> Column:
    """A number that orders a dimension: numbers as they are, strings by how many of ``edges`` are below them."""
    if edges is None:
        return F.col(dim).cast("double")
    below = sum((F.when(F.col(dim).cast("string") > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(F.col(dim).isNotNull(), below.cast("double"))


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (one row per point, one column per dimension).

    The usual two steps on whole arrays: undo the rotations and reflections from the highest bit
    down, Gray-decode across the dimensions, then interleave the bits.
    """
    x = [cells[:, d].astype(np.int64).copy() for d in range(cells.shape[1])]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(len(x)):
            flip = (x[d] >> b) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(len(x)):
            index = (index << 1) | (((x[d] ^ turn) >> b) & 1)
    return index


def _curve(bounds: list[list[float]], bits: int):
    edges = [np.unique(np.asarray(b, dtype=float)) for b in bounds]

    @F.pandas_udf("long")
    def place(codes: pd.DataFrame) -> pd.Series:
        cells = np.stack([
            np.where(np.isnan(v), 0, np.searchsorted(e, v, side="left") if len(e) else 0)
            for e, v in zip(edges, (codes[c].to_numpy(dtype=float) for c in codes.columns))], axis=1)
        return pd.Series(curve_index(cells, bits))

    return place


def hilbert_shards(docs: DataFrame, n_shards: int = 16, dims: tuple[str, ...] = ("lang", "source", "size"),
                   bits: int = 5, whole_share: float = 0.02, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` for every row of ``docs``.

    ``dims`` are columns of ``docs`` or ``size`` (the UTF-8 bytes of the text plus 1).
    """
    return _assigned(docs, n_shards, dims, bits, whole_share, id_col, text_col, ()).select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.col("__curve").alias("curve"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))


def _assigned(docs: DataFrame, n_shards: int, dims: tuple[str, ...], bits: int, whole_share: float,
              id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """The shards under internal names; column ``i`` of ``carry`` goes along as ``__c_i``."""
    ship_package(docs.sparkSession)
    bits = min(bits, 62 // len(dims))
    base = docs.withColumn("__size", (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long"))
    strings = {d: _string_edges(docs, d, 2 ** bits - 1) for d in dims if not _is_number(docs, d)}
    codes = [F.col("__size").cast("double") if d == "size" else _code(docs, d, strings.get(d)) for d in dims]
    base = written(base.select(
        F.col(id_col).alias("__id"), F.col("__size"), F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("__crc"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("__same"),
        F.struct(*[c.alias(f"c{i}") for i, c in enumerate(codes)]).alias("__codes"),
        *[F.col(c).alias(f"__c_{i}") for i, c in enumerate(carry)]), "hilbert-base")
    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    edges = base.agg(*[F.percentile_approx(f"__codes.c{i}", steps, 10000).alias(f"e{i}")
                       for i in range(len(dims))]).first()
    # a string's code is its cell already
    place = _curve([[float(c) for c in range(2 ** bits - 1)] if d in strings else list(e or [])
                    for d, e in zip(dims, edges)], bits)

    # written, so that the join below is between two plain exchanges, whose hot groups AQE can split
    firsts = written(base.groupBy("__same").agg(F.count(F.lit(1)).alias("n"),
                     F.min(F.struct(F.col("__id").isNull(), "__id", "__codes")).alias("f"))
                     .filter("n > 1").select(F.col("__same").alias("__g"), F.col("f.__codes").alias("__gcodes")),
                     "hilbert-firsts")
    laid = (base.join(firsts, F.col("__same") == F.col("__g"), "left")
            .withColumn("__curve", place(F.coalesce("__gcodes", "__codes")))
            .drop("__g", "__gcodes", "__codes"))
    laid = ordered_totals(laid, ["__curve", "__same", "__id"],
                          {"__pos": F.col("__size"), "__rank": F.lit(1).cast("long")}, "hilbert-order")
    laid = written(laid, "hilbert-laid")

    cuts = _cuts(laid, n_shards, whole_share)
    shard = sum((F.when(F.col("__pos") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    laid = laid.withColumn("__shard", shard)
    # one row per shard
    starts = laid.groupBy(F.col("__shard").alias("__s")).agg(F.min("__rank").alias("__first"))
    return (laid.join(F.broadcast(starts), F.col("__shard") == F.col("__s"))
            .withColumn("__slot", (F.col("__rank") - F.col("__first")).cast("long")))


def _cuts(laid: DataFrame, n_shards: int, whole_share: float) -> list[int]:
    """Byte positions of the ``n_shards - 1`` cuts; only rows that a cut hits reach the driver."""
    total = laid.agg(F.sum("__size")).first()[0] or 0
    want = [total * i // n_shards for i in range(1, n_shards)]
    hit = laid.filter(F.exists(F.array(*[F.lit(w) for w in want]),
                               lambda w: (w > F.col("__pos")) & (w < F.col("__pos") + F.col("__size")))) \
        if want else laid.limit(0)
    rows = hit.select("__same", "__pos", "__size").collect()
    ends = {r["__same"]: (r["lo"], r["hi"]) for r in
            laid.filter(F.col("__same").isin([r["__same"] for r in rows]))
            .groupBy("__same").agg(F.min("__pos").alias("lo"), F.max(F.col("__pos") + F.col("__size")).alias("hi"))
            .collect()} if rows else {}
    # a cut on the border of two copies of one text hits no row, so its group is looked up as well
    edge = laid.filter(F.col("__pos").isin(want)).select("__same", "__pos").collect() if want else []
    more = [r["__same"] for r in edge if r["__same"] not in ends]
    if more:
        ends |= {r["__same"]: (r["lo"], r["hi"]) for r in
                 laid.filter(F.col("__same").isin(more)).groupBy("__same")
                 .agg(F.min("__pos").alias("lo"), F.max(F.col("__pos") + F.col("__size")).alias("hi")).collect()}
    cuts = []
    for w in want:
        lo, hi = next(((lo, hi) for lo, hi in ends.values() if lo < w < hi), (w, w))
        cuts.append((lo if w - lo <= hi - w else hi) if hi - lo <= whole_share * total / n_shards else w)
    return cuts


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, files_per_shard: int = 8,
                 dims: tuple[str, ...] = ("lang", "source", "size"), bits: int = 5, whole_share: float = 0.02,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs``, all columns, as Parquet: a folder ``__shard=s`` per shard, each of
    its files a run of the curve."""
    laid = _assigned(docs, n_shards, dims, bits, whole_share, id_col, text_col, tuple(docs.columns))
    (laid.repartitionByRange(n_shards * files_per_shard, "__shard", "__slot")
     .sortWithinPartitions("__shard", "__slot")
     .select("__shard", *[F.col(f"__c_{i}").alias(c) for i, c in enumerate(docs.columns)])
     .write.partitionBy("__shard").parquet(path))
