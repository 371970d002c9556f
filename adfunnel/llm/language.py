"""Operator 8: language identification in two steps.

A text is the square-rooted frequencies of its hashed byte bigrams and trigrams (A-Z folded), whole text, a
vector of length 1.  First one linear model per language family (one against the rest) picks the family;
then, within it, one-versus-one linear support vector machines, one for each pair of languages,
vote, ties by summed margins.  All are fitted with squared hinge loss by accelerated gradient steps.

Learning: a bounded sample of labelled texts, ``per_lang`` different ones for each language (those of least hash), whose
features are made and written by the executors.  Every label gets its models.  A model is fitted in a task of its own, on
``most_rows`` of those texts at most, the same number of each language; only the models
(``dims`` floats each) pass through the driver.  Families are a fixed table; a language that is not in it is a
family of its own.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any labelled text
all are ``und``; with one label all texts with letters get it.  Equal texts get equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import hashing
from .common import ship_package, whole_text, written

#: Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "da", "sv", "no", "is", "af", "yi", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tk"),
    "semitic": ("ar", "he", "mt", "am"),
    "indo_iranian": ("hi", "bn", "ur", "fa", "mr", "ne", "pa", "gu", "si", "ps"),
    "dravidian": ("ta", "te", "kn", "ml"),
}


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"only {lang}")


def _fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    t[65:91] += 32
    t[[9, 10, 11, 12, 13]] = 32
    return t


_FOLD = _fold_table()


def features(data: np.ndarray, firsts: np.ndarray, dims: int, chunk: int = 1 << 17) -> np.ndarray:
    """A row per text: square roots of the frequencies of its hashed bigrams and trigrams; the texts of about
    ``chunk`` bytes at a time, as the arrays take some 60 times that."""
    stops = np.append(firsts[1:], len(data))
    out, at = np.zeros((len(firsts), dims), np.float32), 0
    while at < len(firsts):
        end = max(at + 1, int(np.searchsorted(stops, firsts[at] + chunk, side="right")))
        out[at:end] = _features(data[firsts[at]:stops[end - 1]], firsts[at:end] - firsts[at], dims)
        at = end
    return out


def _features(data: np.ndarray, firsts: np.ndarray, dims: int) -> np.ndarray:
    n = len(firsts)
    b = _FOLD[data]
    of = np.repeat(np.arange(n), np.diff(np.append(firsts, len(b))))
    out = np.zeros(n * dims)
    for size, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        if len(b) < size:
            continue
        g = np.zeros(len(b) - size + 1, np.uint32)
        for i in range(size):
            g = g * np.uint32(257) + b[i:len(b) - size + 1 + i]
        g = (g + np.uint32(size)) * np.uint32(salt)
        g ^= g >> np.uint32(15)
        t = of[:len(g)]
        whole = t == of[size - 1:]
        out += np.bincount(t[whole] * dims + (g[whole] % np.uint32(dims)).astype(np.int64), minlength=n * dims)
    out = out.reshape(n, dims)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1.0)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 0.002, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM, squared hinge, both classes weighing the same; ``y``: +-1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, pace = w, 1.0
    for _ in range(steps):
        short = np.maximum(0, 1 - y * (x @ ahead))
        grad = c * ahead - 2 * (x.T @ (share * y * short))
        new = ahead - grad / (4 + c)
        pace, old = (1 + np.sqrt(1 + 4 * pace * pace)) / 2, pace
        ahead, w = (new + (old - 1) / pace * (new - w)).astype(np.float32), new
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """``weights`` has a column per linear model: the families', then the language pairs'."""
    dims: int
    families: list[str] = field(default_factory=list)
    langs: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, x: np.ndarray, sharp: float = 4.0) -> tuple[list[str], np.ndarray]:
        """Languages and scores: the product of the family's and the languages' pairwise sigmoids."""
        margin = x @ self.weights + self.bias
        likely = lambda z: 1 / (1 + np.exp(-np.clip(sharp * z, -50, 50)))
        f = len(self.families)
        best = margin[:, :f].argmax(axis=1) if f else np.zeros(len(x), int)
        score = likely(margin[np.arange(len(x)), best]) if f > 1 else np.ones(len(x))
        langs = np.empty(len(x), object)
        for i, fam in enumerate(self.families):
            rows = np.flatnonzero(best == i)
            names = self.langs[fam]
            votes, summed = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            doubt = np.ones((len(rows), len(names)))
            for j, (of, a, b) in enumerate(self.pairs):
                if of == fam and len(rows):
                    z = margin[rows, f + j]
                    for lang, side in ((a, z), (b, -z)):
                        k = names.index(lang)
                        votes[:, k] += (side > 0) if lang == a else (side >= 0)
                        summed[:, k] += side
                        doubt[:, k] *= likely(side)
            if len(rows):
                won = (votes + 1e-6 * np.tanh(summed)).argmax(axis=1)
                langs[rows] = np.array(names, object)[won]
                score[rows] *= doubt[np.arange(len(rows)), won]
        return langs.tolist(), score


def _features_of(dims: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, firsts in hashing.byte_batches(batch.column("text"), most=256):
                x = features(data, firsts, dims)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), dims).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(at, end - at), batch.column("k").slice(at, end - at), lists],
                    names=["lang", "k", "x"])

    return make


def _fit_group(dims: int):
    """One model: the rows of a group in the order of language and turn, so that a rerun gives the same weights."""
    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("k", "ascending")])
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        w, b = fit_svm(x, table.column("y").to_numpy().astype(np.float32))
        return pa.table({"model": table.column("model").slice(0, 1), "w": pa.array([w], pa.list_(pa.float32())),
                         "b": pa.array([b], pa.float64())})

    return fit


def _sample(labelled: DataFrame, per_lang: int, text_col: str, lang_col: str) -> DataFrame:
    """``lang, text, k``: of every language the ``per_lang`` different texts with letters of least hash, ``k`` from 1."""
    rows = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                            F.xxhash64(text_col).alias("turn"))
            .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")))
    # thin by hash first, so that the ordering sees a bounded number of rows of a language with many
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("turn").alias("n")).collect()}
    shares = {lang: (2.0 * per_lang + 100) / n for lang, n in sizes.items() if n > 2 * per_lang + 100}
    if shares:
        share = F.element_at(F.create_map(*[F.lit(v) for kv in sorted(shares.items()) for v in kv]), F.col("lang"))
        rows = rows.filter(F.pmod("turn", F.lit(1 << 40)) < F.coalesce(share, F.lit(1.0)) * float(1 << 40))
    first = W.partitionBy("lang").orderBy("turn")
    return (rows.dropDuplicates(["lang", "turn"]).withColumn("k", F.row_number().over(first))
            .filter(F.col("k") <= per_lang).select("lang", "text", "k"))


def learn(labelled: DataFrame, per_lang: int = 500, dims: int = 2048, most_rows: int = 10000,
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on ``per_lang`` different texts with letters of each language of ``labelled``."""
    spark = labelled.sparkSession
    ship_package(spark)
    sample = written(_sample(labelled, per_lang, text_col, lang_col)
                     .mapInArrow(_features_of(dims), "lang string, k int, x array<float>"), "language-sample")
    model = Model(dims)
    for lang in sorted(r["lang"] for r in sample.select("lang").distinct().collect()):
        model.langs.setdefault(family_of(lang), []).append(lang)
    model.families = sorted(model.langs)
    tasks = []  # (model, language, label, rows of the language): a language against those of other families, or one
    n_langs = sum(map(len, model.langs.values()))
    if len(model.families) > 1:
        tasks += [(i, lang, 1 if f == own else -1, max(1, most_rows // n_langs))
                  for i, f in enumerate(model.families) for own in model.families for lang in model.langs[own]]
    for f in model.families:
        names = model.langs[f]
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                at = len(model.families) + len(model.pairs)
                tasks += [(at, a, 1, most_rows // 2), (at, b, -1, most_rows // 2)]
                model.pairs.append((f, a, b))
    n = len(model.families) + len(model.pairs)
    model.weights, model.bias = np.zeros((dims, n), np.float32), np.zeros(n)
    if tasks:
        wanted = spark.createDataFrame(tasks, "model int, lang string, y int, most int")
        fitted = (sample.join(wanted, "lang").filter(F.col("k") <= F.col("most")).select("model", "lang", "k", "y", "x")
                  .groupBy("model").applyInArrow(_fit_group(dims), "model int, w array<float>, b double"))
        for r in fitted.collect():
            model.weights[:, r["model"]], model.bias[r["model"]] = r["w"], r["b"]
    return model


def _predictor(model: Model, undetermined: str, with_text: bool):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for at, end, data, firsts in hashing.byte_batches(pc.fill_null(batch.column("text"), ""), most=256):
                if not model.families:
                    got, score = [undetermined] * (end - at), np.zeros(end - at)
                else:
                    got, score = model.predict(features(data, firsts, model.dims))
                langs += got
                scores.append(score)
            has = batch.column("has").to_numpy(zero_copy_only=False)
            score = np.where(has, np.concatenate(scores) if scores else np.zeros(0), 0.0)
            langs = [x if h else undetermined for x, h in zip(langs, has)]
            columns = batch.schema.names[1 if with_text else 2:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(score, pa.float64()), *map(batch.column, columns)],
                names=["lang_pred", "score", *columns])

    return predict


def identify(docs: DataFrame, model: Model, keep: dict[str, Column], undetermined: str = "und",
             text_col: str = "text", text_as: str | None = None) -> DataFrame:
    """``lang_pred, score`` and the columns ``keep`` for every row; one pass, no shuffle.  ``text_as``: the name under which
    the text comes back too, so that it need not go to the workers a second time in ``keep``."""
    ship_package(docs.sparkSession)
    fed = docs.select(whole_text(text_col).rlike(r"\p{L}").alias("has"), F.col(text_col).alias("text"),
                      *[v.alias(f"k{i}") for i, v in enumerate(keep.values())])
    kinds = [f"k{i} {fed.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    if text_as:
        kinds.insert(0, "text string")
    out = fed.mapInArrow(_predictor(model, undetermined, bool(text_as)), ", ".join(["lang_pred string, score double", *kinds]))
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)],
                      *([F.col("text").alias(text_as)] if text_as else []), "lang_pred", "score")
