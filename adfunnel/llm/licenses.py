"""Operator 3: licence scan.  Native DataFrame code.

Units of every text are compared with licence templates by sparse TF-IDF cosine: the whole text, its header
(leading comment or paragraph), the header's sentences (a notice wrapped over lines is one again), every line and the
sentences of a line.  Templates are one-sentence notices and full licence texts (``license_texts``).  A file has the
licence of its best unit.  A file whose whole text reaches the threshold, or of which at least ``file_share`` of the
words stand in licence lines, is a licence file: it speaks for its directory.  Files without a licence of their own
inherit that of the nearest ancestor directory that has one, found by joining the directories to their ancestors.

Weights: a token's IDF is ``ln((1 + N) / (1 + df)) + 1`` with document frequencies over the whole corpus,
counted for the tokens of the templates; any other token weighs as one never seen, so a unit is not matched by
dropping what it says besides.  Only units that can reach the threshold are split into tokens: by the
Cauchy-Schwarz inequality a unit that lacks all the heaviest tokens of a template (of those not common in the
corpus first), up to where the rest
of the template's norm is under the threshold, stays below it.  This prefix filter loses no match.

Defined cases: a null text has no lines; a null path part counts as ``_``; ties go to the template named
first; two licence files in one directory: the higher score, then the smaller id, speaks; repeated rows count as
one file each and share their result.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, whole_text, words, written

#: Licence notices by SPDX identifier, one line each.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
)


#: The leading comment, or else the leading paragraph, of a text.
HEADER = (r"(?s)^\s*(?:/\*.*?\*/|<!--.*?-->|(?:[ \t]*+(?:#|//|--|;|%|\*)[^\n]*+(?:\n|$))++"
          r"|.*?(?=\n[ \t\r]*\n|$))")
#: The end of a sentence.
STOP = r"""(?<=[.;:!?])["')]*\s+"""


def full_texts() -> tuple[tuple[str, str], ...]:
    """The full licence texts, by SPDX identifier."""
    folder = Path(__file__).parent / "license_texts"
    return tuple((p.stem, p.read_text("utf-8")) for p in sorted(folder.glob("*.txt")))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits (ASCII)."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def _split(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _either(choices: set[str]) -> str:
    """A regular expression for one of some words of letters and digits, common beginnings first: a text is
    compared with each beginning once, not with each word."""
    rests: dict[str, set[str]] = {}
    for w in choices - {""}:
        rests.setdefault(w[0], set()).add(w[1:])
    if not rests:
        return ""
    branches = "|".join(c + _either(rest) for c, rest in sorted(rests.items()))
    return f"(?:{branches}){'?' if '' in choices else ''}"


def _weights(docs: DataFrame, templates, text_col: str) -> tuple[dict[str, float], float]:
    """IDF of the templates' tokens over all documents, and that of a token never seen."""
    vocabulary = sorted({t for _, text in templates for t in _split(text)})
    # empty pieces of the split are no tokens of the templates
    held = F.array_intersect(F.split(F.lower(whole_text(text_col)), "[^a-z0-9]+"),
                             F.split(F.lit(" ".join(vocabulary)), " "))
    # explode() would be given a filter that makes the array again, explode_outer() is not
    df = {r["token"]: r["n"] for r in docs.select(F.explode_outer(held).alias("token"))
          .filter(F.col("token").isNotNull()).groupBy("token")
          .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row per template token
    n = docs.count()
    idf = lambda k: math.log((1 + n) / (1 + k)) + 1
    return {t: idf(df.get(t, 0)) for t in vocabulary}, idf(0)


def _template_vectors(templates, idf: dict[str, float]) -> list[dict[str, float]]:
    out = []
    for _, text in templates:
        v: dict[str, float] = {}
        for t in _split(text):
            v[t] = v.get(t, 0.0) + idf[t]
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({t: x / norm for t, x in v.items()})
    return out


def _must_hold(vector: dict[str, float], threshold: float, common: set[str]) -> set[str]:
    """The heaviest tokens of a template, ``common`` ones last, without all of which the cosine stays under the
    threshold."""
    rest, prefix = sum(x * x for x in vector.values()), set()
    for t, x in sorted(vector.items(), key=lambda p: (p[0] in common, -p[1], p[0])):
        if rest < threshold * threshold * (1 - 1e-9):
            break
        prefix.add(t)
        rest -= x * x
    return prefix


def licence_units(docs: DataFrame, templates, texts, threshold: float = 0.7, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``key, line_no, piece, n_words, license, score`` of the units that reach the threshold: the lines (``piece`` 0)
    and their sentences, as ``line_no`` -1 the header and its sentences, as -2 the whole text."""
    spark = docs.sparkSession
    every = (*templates, *texts)
    idf, unseen = _weights(docs, every, text_col)
    vectors = _template_vectors(every, idf)
    common = {t for t, x in idf.items() if x < math.log(20) + 1}  # in more than a twentieth of the documents
    short = {t for v in vectors[:len(templates)] for t in _must_hold(v, threshold, common)}
    full = {t for v in vectors[len(templates):] for t in _must_hold(v, threshold, common)}

    def some(text: Column, needed: set[str]) -> Column:
        heads = "".join(sorted({w[0] for w in needed}))
        return F.lower(text).rlike(f"(?<![a-z0-9])(?=[{heads}]){_either(needed)}(?![a-z0-9])") if needed else F.lit(False)

    def with_sentences(text: Column) -> Column:
        parts = F.split(text, STOP, -1)
        return F.when(F.size(parts) > 1, F.concat(F.array(text), parts)).otherwise(F.array(text))

    held = (docs.select(row_key(id_col, text_col).alias("key"), whole_text(text_col).alias("t"))
            .filter(some(F.col("t"), short | full)))
    whole = held.select("key", F.lit(-2).alias("line_no"), F.lit(0).alias("piece"), F.col("t").alias("unit"))
    header = held.select("key", F.lit(-1).alias("line_no"), F.posexplode(
        with_sentences(F.regexp_extract("t", HEADER, 0))).alias("piece", "unit"))
    line = (held.filter(some(F.col("t"), short))
            .select("key", F.posexplode_outer(F.split("t", "\n", -1)).alias("line_no", "line"))
            .filter(some(F.col("line"), short))
            .select("key", "line_no", F.posexplode(with_sentences(F.col("line"))).alias("piece", "unit")))
    unit = ["key", "line_no", "piece"]
    units = (whole.unionByName(header).unionByName(line).filter(some(F.col("unit"), short | full))
             .select("key", "line_no", "piece", F.size(words(F.col("unit"))).alias("n_words"),
                     F.sort_array(tokens(F.col("unit"))).alias("ts")))
    # the runs of equal tokens, counted inside the row, so that one row per unit and task is shuffled
    units = units.withColumn("at", F.array_compact(F.transform(
        "ts", lambda x, i: F.when((i == 0) | (x != F.get("ts", i - 1)), i))))
    ends = F.concat(F.slice("at", F.lit(2), F.size("at")), F.array(F.size("ts")))
    units = units.withColumn("runs", F.zip_with("at", ends, lambda i, end: F.struct(
        F.get("ts", i).alias("token"), (end - i).alias("tf")))).drop("ts", "at")
    unit = [*unit, "n_words"]
    # explode() would be given a filter that makes the array again, explode_outer() is not
    terms = units.select(*unit, F.size("runs").alias("kinds"), F.explode_outer("runs").alias("r")) \
        .select(*unit, "kinds", "r.token", "r.tf")
    # a row per token of the templates, a few thousand, with its weight in each template
    ids = range(len(vectors))
    table = spark.createDataFrame([(t, float(w), *[v.get(t) for v in vectors]) for t, w in idf.items()],
                                  "token string, idf double, " + ", ".join(f"w{i} double" for i in ids))
    x = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    sums = (terms.join(F.broadcast(table), "token", "left").groupBy(*unit)
            .agg((F.count(F.lit(1)) / F.max("kinds")).alias("rows"), F.sum(x * x).alias("square"),
                 *[F.sum(x * F.col(f"w{i}")).alias(f"dot{i}") for i in ids]))
    # repeated rows add up in both sums, the dot product and the squared norm
    dots = sums.select(*unit, F.sqrt(F.col("square") * F.col("rows")).alias("norm"), F.array_max(F.array(*[
        F.struct(F.coalesce(f"dot{i}", F.lit(0.0)).alias("dot"), F.lit(-i).alias("first")) for i in ids])).alias("best"))
    names = F.array(*[F.lit(n) for n, _ in every])
    return (dots.withColumn("score", F.least(F.lit(1.0), F.col("best.dot") / F.col("norm")))
            .filter(F.col("score") >= threshold - 1e-9)
            .select(*unit, names[-F.col("best.first")].alias("license"), "score"))


def scan_licences(docs: DataFrame, path: Column, templates=TEMPLATES, threshold: float = 0.7,
                  file_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text", texts=None) -> DataFrame:
    """Per row: id, ``path``, ``own_license``, ``score``, ``is_license_file``, ``license``, ``found_in``.

    ``path``: slash-separated, ending in the file's name.  ``found_in`` is ``file``, the directory that the
    licence was inherited from, or null.
    """
    base = docs.select(F.col(id_col).alias("id"), path.alias("path"), row_key(id_col, text_col).alias("key"),
                       F.size(words(F.col(text_col))).alias("n_words"))
    part = F.when(F.col("piece") > 0, F.col("n_words")).otherwise(0)
    # a line counts once: whole, or those of its sentences that match
    hits = (licence_units(docs, templates, full_texts() if texts is None else texts, threshold, id_col, text_col)
            .groupBy("key", "line_no").agg(
                F.max(F.struct("score", (-F.col("piece")).alias("p"), "license")).alias("best"),
                F.greatest(F.sum(part), F.max(F.col("n_words") - part)).alias("n_words"))
            .groupBy(F.col("key").alias("k")).agg(
                F.max(F.struct("best.score", (-F.col("line_no")).alias("l"), "best.license")).alias("best"),
                F.max(F.col("line_no") == -2).alias("whole"),
                F.sum(F.when(F.col("line_no") >= 0, F.col("n_words"))).alias("n_licence_words")))
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    files = written(base.join(hits, F.col("key") == F.col("k"), "left").select(
        "id", "path", folder.alias("dir"), F.col("best.license").alias("own_license"), F.col("best.score").alias("score"),
        (F.coalesce(F.col("n_licence_words") >= file_share * F.col("n_words"), F.lit(False))
         | F.coalesce("whole", F.lit(False))).alias("is_license_file")),
        "licence-files")

    # one row per directory that a licence file speaks for, one row per directory that has files
    spoken = (files.filter("is_license_file").groupBy(F.col("dir").alias("ancestor"))
              .agg(F.max(F.struct("score", (-F.col("id")).alias("i"), "own_license")).alias("s"))
              .select("ancestor", F.col("s.own_license").alias("dir_license")))
    parts = F.split("dir", "/")
    ancestors = (files.select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts))))
                 .withColumn("ancestor", F.when(F.col("depth") == 0, "").otherwise(
                     F.concat_ws("/", F.slice(parts, F.lit(1), F.col("depth"))))))
    nearest = (ancestors.join(spoken, "ancestor").groupBy(F.col("dir").alias("of"))
               .agg(F.max(F.struct("depth", "ancestor", "dir_license")).alias("n")))
    own = F.col("own_license").isNotNull()
    return (files.join(nearest, F.col("dir") == F.col("of"), "left")
            .select(F.col("id").alias(id_col), "path", "own_license", "score", "is_license_file",
                    F.coalesce("own_license", "n.dir_license").alias("license"),
                    F.when(own, "file").otherwise(F.col("n.ancestor")).alias("found_in")))
