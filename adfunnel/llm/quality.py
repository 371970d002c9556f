"""Operator 6: quality by weak supervision.  Native DataFrame code.

Rules look at counts of a document and vote for it (1), against it (-1) or abstain (0).  No rule is trusted
beforehand: expectation-maximisation over all documents estimates, for each rule, how it votes on good
documents and on each kind of junk, and the posterior probability of being good replaces an all-must-pass filter:
a lone vote against that looks like an error of its rule is outvoted.

A vote pattern says all that the model sees of a document, so the documents are counted by pattern once and the
iterations run on that table: at most ``3 ** len(RULES)`` rows (2,187) however many documents there are.
Each iteration is one aggregation returning a row of sums per class, from which the next posterior is made.

Counts: words are runs of ``[^\\x20\\x09-\\x0D]``.  ``n_dup_lines`` are lines with a word that equal an
earlier one; ``n_repeat_words`` are words in 5-word windows found twice or more in the text.  Windows are
compared by 64-bit hashes inside their document.

Defined cases: a null or blank text has no words and fails the base test; rows are decided one by one, so repeated
rows get the same verdict; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, whole_text, words, written

SYMBOLS = "[#*$%&|<>]"
UPPER = "[A-ZÀ-ÖØ-Þ]"


@dataclass(frozen=True)
class Rule:
    """Votes against from ``bad`` on, for up to ``good`` (None: never), and abstains otherwise (``low``: the
    other way round, against up to ``bad`` and for from ``good`` on).  Abstains on texts of fewer words than
    ``from_words``."""
    name: str
    share: str
    bad: float
    good: float | None = None
    low: bool = False
    from_words: int = 0

    def vote(self) -> Column:
        x = F.expr(self.share)
        v = F.when(x <= self.bad if self.low else x >= self.bad, -1)
        if self.good is not None:
            v = v.when(x >= self.good if self.low else x <= self.good, 1)
        return F.when((F.col("n_words") < self.from_words) | x.isNull(), 0).otherwise(v.otherwise(0))


#: The rules.  Shares are of words, lines with a word, or characters of words; null where there are none.
RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.1, 0.002),
    Rule("capitals", "try_divide(n_upper, word_chars)", 0.3, from_words=5),
    Rule("dup_lines", "try_divide(n_dup_lines, n_lines)", 0.5),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", 0.2, 0.02),
    Rule("line_ends", "try_divide(n_ended, n_lines)", 0.5, 0.85, low=True),
    Rule("distinct", "try_divide(n_distinct, n_words)", 0.2, low=True, from_words=50),
    Rule("word_length", "try_divide(word_chars, n_words)", 12.0),
)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of every document, one narrow pass over the texts."""
    t = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    t = t.withColumns({"w": words(F.col("t")), "ls": F.filter(F.split("t", "\n", -1),
                                                             lambda x: F.btrim(x, F.lit(WS)) != "")})
    t = t.select(
        "id", "w", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(UPPER)).cast("long").alias("n_upper"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("ls", lambda x: F.substring(F.btrim(x, F.lit(WS)), -1, 1).isin(*'.!?"”»:;')))
        .cast("long").alias("n_ended"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))
    return _repeats(t).drop("w")


def _repeats(t: DataFrame, few: int = 64) -> DataFrame:
    """Adds ``n_repeat_words``: the words that the five-word windows found twice or more cover.

    The hashes of the windows come from those of the words, of pairs and of fours.  Only texts with a
    repeated window get past the next step, where the repeated hashes are those equal to their neighbour once
    sorted.  Their places are looked up if they are few, else found by sorting hashes and places together.
    Each place covers five words or as far as the next one.
    """
    pair = lambda a, b: F.xxhash64(a, b)
    tail = lambda c, n: F.slice(c, F.lit(n + 1), F.size(c))
    t = t.withColumn("g", F.transform("w", lambda x: F.xxhash64(x)))
    t = t.withColumn("h2", F.zip_with("g", tail("g", 1), pair))
    t = t.withColumn("h4", F.zip_with("h2", tail("h2", 2), pair))
    t = t.withColumn("h", F.when(F.col("n_words") >= 5, F.slice(
        F.zip_with("h4", tail("g", 4), pair), F.lit(1), F.greatest(F.size("g") - 4, F.lit(1)))))
    t = t.withColumn("some", F.coalesce(F.size(F.array_distinct("h")) < F.size("h"), F.lit(False)))
    t = t.withColumn("sorted", F.when(F.col("some"), F.sort_array("h")))
    t = t.withColumn("again", F.array_distinct(F.array_compact(F.zip_with(
        "sorted", tail("sorted", 1), lambda a, b: F.when(a == b, a)))))
    places = lambda x, i: F.when(F.array_contains("again", x), i)
    t = t.withColumn("at", F.when(F.size("again") <= few, F.array_compact(F.transform("h", places))))
    t = t.withColumn("s", F.when(F.size("again") > few, F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    before = F.concat(F.array(F.lit(None).cast("struct<x:bigint,i:int>")), F.slice("s", F.lit(1), F.size("s") - 1))
    t = t.withColumn("p", F.zip_with("s", before, lambda a, b: F.struct(
        a["i"].alias("i"), a["x"].eqNullSafe(b["x"]).alias("e"))))
    after = F.concat(tail("p", 1), F.array(F.lit(None).cast("struct<i:int,e:boolean>")))
    t = t.withColumn("at", F.coalesce("at", F.sort_array(F.array_compact(F.zip_with(
        "p", after, lambda a, b: F.when(a["e"] | F.coalesce(b["e"], F.lit(False)), a["i"]))))))
    ends = F.concat(tail("at", 1), F.array(F.lit(None).cast("int")))
    covered = F.aggregate(F.zip_with("at", ends, lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5)))),
                          F.lit(0), lambda acc, x: acc + x)
    return (t.withColumn("n_repeat_words", F.when(F.col("some"), covered).otherwise(0).cast("long"))
            .drop("g", "h2", "h4", "h", "some", "sorted", "again", "at", "s", "p"))


Model = dict[int, tuple[float, dict[str, tuple[float, float]]]]


def _start(rules: list[str], noise: float) -> Model:
    """Class 0 is good; class ``k`` is the kind of junk that rule ``k - 1`` is made to find.  A class has a share
    of the documents and, per rule, how often it votes against and for."""
    kinds = {c + 1: (0.2 / len(rules), {r: (0.8, 0.1) if r == own else (0.2, 0.4) for r in rules})
             for c, own in enumerate(rules)}
    return {0: (0.8, {r: (noise, 0.8) for r in rules}), **kinds}


def _posteriors(votes: DataFrame, model: Model, name: str) -> DataFrame:
    """``votes`` with the array ``name``: the probability of each class given the votes.  An abstention says nothing."""
    number = lambda x: f"{x!r}D"
    like = [" + ".join([number(math.log(share)), *[
        f"CASE `{r}` WHEN -1 THEN {number(math.log(against))} WHEN 1 THEN {number(math.log(for_))} ELSE 0D END"
        for r, (against, for_) in rates.items()]]) for share, rates in (model[c] for c in sorted(model))]
    likely = F.transform("__log", lambda x: F.exp(x - F.col("__most")))
    return (votes.withColumn("__log", F.array(*[F.expr(x) for x in like]))
            .withColumn("__most", F.array_max("__log")).withColumn("__log", likely)
            .withColumn("__most", F.aggregate("__log", F.lit(0.0), lambda acc, x: acc + x))
            .withColumn(name, F.transform("__log", lambda x: x / F.col("__most"))).drop("__log", "__most"))


def fit(votes: DataFrame, rules: list[str], rounds: int = 30, noise: float = 0.005) -> Model:
    """EM on the pattern table: one class of good documents and one kind of junk per rule.

    All rates are estimated from the documents.  What makes class 0 the good one is its prior: as many imagined
    documents as there are real ones, on which a rule votes against at the rate ``noise``.  So a vote against that
    is rarer than a rule's errors, and that no other rule supports, is taken for an error of the rule; one
    that a kind of junk explains (votes of other rules agree, or more documents have it than errors explain) counts
    against the document.  Junk of one kind need not look like that of another, which two classes would ask for.
    Without that prior (a hundredth of it) EM takes junk that trips one rule only for a kind of good text.
    """
    patterns = written(votes.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    # at most 3 ** len(rules) rows, however many documents there are
    patterns = patterns.coalesce(1)
    first = model = _start(rules, noise)
    for _ in range(rounds):
        per_class = _posteriors(patterns, model, "__p").select("n", *rules, F.posexplode("__p").alias("__class", "__p")) \
            .withColumn("__np", F.col("n") * F.col("__p"))
        rows = {r["__class"]: r for r in per_class.groupBy("__class").agg(
            F.sum("n").alias("n"), F.sum("__np").alias("all"),
            *[F.sum(F.when(F.col(r) == v, F.col("__np")).otherwise(0.0)).alias(f"{side}{i}")
              for i, r in enumerate(rules) for side, v in (("against", -1), ("for", 1))]).collect()}
        if not rows:
            return model
        total, new = rows[0]["n"], {}
        for c, row in rows.items():
            rates = {}
            for i, r in enumerate(rules):
                against, for_ = first[c][1][r]
                # one imagined document at the start's rate keeps the rates of rules that never vote off 0
                prior = total + 1 if c == 0 else 1
                rates[r] = ((row[f"against{i}"] + prior * against) / (row["all"] + prior),
                            (row[f"for{i}"] + for_) / (row["all"] + 1))
            new[c] = ((row["all"] + 1) / (total + len(model)), rates)
        model = dict(sorted(new.items()))
    return model


def score_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, rounds: int = 30,
                  noise: float = 0.005, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, the counts, a vote per rule (``v_<rule>``), ``p_good``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 10 words, or over 20% of the words in repeated windows.
    """
    names = [f"v_{r.name}" for r in rules]
    votes = written(counts(docs, id_col, text_col).withColumns({f"v_{r.name}": r.vote() for r in rules}),
                    "quality-votes")
    model = fit(votes, names, rounds, noise)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (_posteriors(votes, model, "p_good").withColumn("p_good", F.col("p_good")[0])
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
            .withColumnRenamed("id", id_col))
