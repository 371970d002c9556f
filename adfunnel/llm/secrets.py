"""Operator 5: secret scan through a trigram inverted index.  Native DataFrame code.

Each rule is a regular expression.  From its syntax a Boolean trigram query is derived (``trigrams.derive``): an OR of
ANDs of trigrams that the text of every match must hold (lower-cased, so a query holds for either case).  The
inverted index keeps, for the trigrams that the queries name, the postings (document keys); the queries are
answered by intersecting postings, and only the candidates are verified by the regular expression.  A rule without
mandatory trigrams (hexadecimal runs) scans every text.

Spans come from cutting the text at the rule's matches: the pieces between matches and the matches add up
to the code-point offsets.  Matches are leftmost and non-overlapping per rule, found before the
length test; a match that fails the test is consumed and dropped.

Defined cases: a null text is empty and holds nothing; rows with the same id and text share their
postings; spans of different rules may overlap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfunnel.session import new_scratch_path

from .common import row_key, whole_text
from .trigrams import derive


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` code points or more."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    def query(self) -> list[list[str]]:
        """OR of ANDs of trigrams; empty if a match need not hold any, so that all is scanned."""
        return derive(self.pattern)

    def search(self) -> str:
        """The pattern that finds the spans.  The matches of one repeated class are its maximal runs, so there the
        length test goes into the pattern and the runs that fail it are never made."""
        run = re.fullmatch(r"\(?(\[[^]\[\\]+\])\+\)?", self.pattern)
        return f"({run[1]}{{{self.least},}})" if run and self.group <= 1 else self.pattern


#: The rules of the scan; the first three are the base set.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"(AKIA[A-Z0-9]+)", 0, 20),
    Rule("hex", r"([0-9a-f]+)", 0, 24),
    Rule("github", r"(gh[pousr]_[A-Za-z0-9]{36,})"),
    Rule("slack", r"(xox[baprs]-[A-Za-z0-9-]{10,})"),
    Rule("google", r"(AIza[0-9A-Za-z_-]{35})"),
    Rule("stripe", r"((?:sk|rk)_live_[0-9A-Za-z]{16,})"),
    Rule("private_key", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)"),
)
BASE = ("assign", "access", "hex")


def write_index(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> None:
    """Write the postings ``(trigram, key)``, a folder per trigram, of the trigrams that the rules name."""
    grams = sorted({g for r in rules for c in r.query() for g in c})

    def held(low: Column) -> Column:
        return F.array_compact(F.array(*[F.when(low.contains(g), F.hex(F.lit(g))) for g in grams]))

    # the lambda's variable holds the lower-cased text, which is made once for all trigrams
    found = F.flatten(F.transform(F.array(F.lower(whole_text(text_col))), held))
    # explode() would be given a filter that makes the array again, explode_outer() is not
    # rebalanced, so that a task writes few folders and a trigram in most texts is split over several tasks
    (docs.select(row_key(id_col, text_col).alias("key"), F.explode_outer(found).alias("trigram"))
     .filter(F.col("trigram").isNotNull()).hint("rebalance", "trigram").write.partitionBy("trigram").parquet(path))


def candidates(spark, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key, kinds``: the rules whose trigram query a document answers."""
    postings = spark.read.schema("key string, trigram string").parquet(path)
    hexed = lambda g: g.encode().hex().upper()
    has = {g: F.max(F.col("trigram") == hexed(g)) for r in rules for c in r.query() for g in c}
    grams = postings.groupBy("key").agg(*[v.alias(f"g_{hexed(g)}") for g, v in sorted(has.items())])

    def holds(rule: Rule) -> Column:
        every = [reduce(lambda a, b: a & b, [F.col(f"g_{hexed(g)}") for g in c]) for c in rule.query()]
        return reduce(lambda a, b: a | b, every)

    asked = [F.when(holds(r), F.lit(r.kind)) for r in rules if r.query()]
    return (grams.select("key", F.array_compact(F.array(*asked)).alias("kinds")).filter(F.size("kinds") > 0))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule: array of (start, order, kind, end)."""
    pattern = rule.search()
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), F.char_length)
    tested = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), F.char_length)
    rows = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("gap"),
                        F.transform(whole, F.char_length).alias("len"), tested.alias("test"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)")
                     .alias("spans"))

    def add(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + x["len"]
        span = F.array(F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"),
                                end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["test"] >= rule.least, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(rows, start, add, lambda acc: acc["spans"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text", index_path: str | None = None) -> DataFrame:
    """``doc_id, spans`` per row of ``docs``; spans: array of (start, ord, kind, end) in code points,
    end exclusive, by start and then in the order of ``rules``."""
    spark = docs.sparkSession
    path = index_path or new_scratch_path(spark, "secret-index")
    write_index(docs, path, rules, id_col, text_col)
    found = candidates(spark, path, rules).withColumnRenamed("key", "k")
    text = F.col("__text")
    none = F.expr("cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)")
    verified = []
    for i, r in enumerate(rules):
        ask = F.array_contains("kinds", r.kind) if r.query() else text.rlike(r.search())
        verified.append(F.when(ask, _spans(text, r, i)).otherwise(none))
    return (docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text"),
                        row_key(id_col, text_col).alias("__key"))
            .join(found, F.col("__key") == F.col("k"), "left")
            .select(F.col("__id").alias(id_col), F.sort_array(F.concat(*verified)).alias("spans")))
