"""Operator 9: mixing sources to target weights by entropy balancing.  Native DataFrame code.

A document's size is its number of words.  Entropy balancing looks for rates ``r_i`` that meet every
source's token target with the least relative entropy to the corpus, ``min sum size_i (r_i log r_i -
r_i)``.  The dual is convex and its solution tilts exponentially, ``r_i = exp(lambda . x_i)`` with x_i the
source's indicator.  Newton steps ``lambda += (T - S e^lambda) / (S e^lambda)`` run on the table of
source totals: a document belongs to one source, so the dual's Hessian is diagonal and each step is a
column expression over one row per source, without a shuffle.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share all words;
a target stops at ``max_copies`` times its source, the excess is shared by weight among the others
until none is above (``min(cap, weight * level)``, the level found from running sums in cap order).

Rates become copies: everyone gets ``floor(r)``, and the fraction is dealt systematically along the
source's documents in the order of size (then a hash): document number k gets one more when
``floor(k f + 1/2)`` moves on.  Evenly spread over the sizes, the words taken miss the target by about one
document.  The place in that order is a distributed prefix count, so a hot source is cut over many tasks.

Defined cases: null or blank text has size 0 and takes 0; a source of size 0 has target 0; null is a
source of its own; repeated rows are separate rows; an empty table gives no rows.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ordered_totals, words, written


def source_targets(totals: DataFrame, max_copies: int = 3, cycle: int = 3) -> DataFrame:
    """``source, source_size`` to ``target``.  The table of sources (one row each) is ordered as a whole."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumns({
        "w": (F.pmod(F.row_number().over(by_name) - 1, F.lit(cycle)) + 1).cast("double"),
        "cap": (F.col("source_size") * max_copies).cast("double"),
        "whole": F.sum("source_size").over(W.partitionBy()).cast("double")})
    # sources in the order in which they reach their cap; with those before it capped, a source's level
    # is what is left over the weights that are left
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    done = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = t.withColumn("level", (F.col("whole") - F.coalesce(F.sum("cap").over(done), F.lit(0.0)))
                     / F.sum("w").over(rest))
    # the first source that stays under its cap fixes the level
    t = t.withColumn("at", F.min(F.when(F.col("cap") > F.col("w") * F.col("level"),
                                        F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(W.partitionBy()))
    level = F.col("at.level")
    return t.select("source", "source_size",
                    F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * level))
                    .alias("target"))


def tilt(targets: DataFrame, steps: int = 60) -> DataFrame:
    """Adds ``rate = exp(lambda)`` by damped Newton steps on the dual."""
    s, goal = F.col("source_size").cast("double"), F.col("target")

    def step(lam, _):
        moved = s * F.exp(lam)
        return lam + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(goal - moved, moved)))

    lam = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)
    return targets.withColumn("rate", F.when((s > 0) & (goal > 0), F.exp(lam)).otherwise(F.lit(0.0)))


def mix_sources(docs: DataFrame, max_copies: int = 3, cycle: int = 3, seed: int = 9, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", keep: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, source, text_hash, size, source_size, target, rate, copies`` per row of ``docs``, and the columns
    ``keep`` (narrow ones: they are sorted with the rows)."""
    keep = keep or {}
    base = written(docs.select(
        *[v.alias(f"k{i}") for i, v in enumerate(keep.values())],
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text_hash"),
        F.size(words(F.col(text_col))).cast("long").alias("size")), "mix-base")
    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = tilt(source_targets(totals, max_copies, cycle))
    rates = written(rates.withColumnRenamed("source", "of"), "mix-rates")
    base = base.withColumn("turn", F.xxhash64("id", "text_hash", F.lit(seed)))
    placed = ordered_totals(base, ["source", "size", "turn", "id"], {"k": F.lit(1).cast("long")}, "mix-order",
                            group=["source"])
    # a rate within rounding of a whole number is that number
    whole = F.floor(F.col("rate") + 1e-9)
    part = F.greatest(F.col("rate") - whole, F.lit(0.0))
    more = F.floor((F.col("k") + 1) * part + 0.5) - F.floor(F.col("k") * part + 0.5)
    copies = F.least(whole + more, F.lit(max_copies)).cast("long")
    return (placed.join(rates, F.col("source").eqNullSafe(F.col("of")), "left")
            .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "text_hash", "size", "source_size",
                    "target", "rate", copies.alias("copies"), *[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)]))
