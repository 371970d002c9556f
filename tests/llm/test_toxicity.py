"""Deobfuscation against every path of the lattice, counts against brute force, scores on held-out rows and odd rows."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfunnel.llm import queries as Q
from adfunnel.llm import toxicity as X

SF = "/root/testdata/sf0.1"
INSULTS = "idiot moron stupid worthless loser clown scum trash pathetic disgusting".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def cost(docs):
    return X.language_model(docs)


@pytest.fixture(scope="module")
def model(spark, docs, cost):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("crc32(cast(doc_id as string)) % 3 != 1")
    return X.learn(docs, labels, cost)


def _cells(texts):
    """Brute force: (three symbols before, symbol), word by word."""
    out = Counter()
    for text in texts:
        for word in "".join(chr(97 + X._symbol(c)) if X._symbol(c) else " " for c in text).split(" "):
            symbols = [0, 0, 0, *[ord(c) - 97 for c in word], 0]
            if word:
                out.update(tuple(symbols[i:i + 4]) for i in range(len(symbols) - 3))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_ngram_cells(piece):
    texts = ["The cat, the CAT.", "", "Élan x2 日本\n\nend", " ", "z"]
    got = Counter()
    for cells in X.ngram_cells(texts, piece):
        for c in cells.tolist():
            got[(c // 28 ** 3, c // 28 ** 2 % 28, c // 28 % 28, c % 28)] += 1
    assert got == _cells(texts)


def test_language_model_counts_every_document(spark):
    texts = ["abc abd", None, "", "abc"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = np.zeros((28,) * 4)
    for cell, n in _cells(t or "" for t in texts).items():
        counts[cell] = n
    assert np.allclose(X.language_model(frame), X.smoothed(counts))
    assert np.allclose(np.exp(-X.smoothed(counts)).reshape(-1, 28).sum(axis=1), 1)


def _price(text, cost):
    """The language model's cost of a reading; runs of spaces count once, none at the beginning."""
    total, state = 0.0, 0
    for c in [*text, " "]:
        s = X._symbol(c)
        if s == 0 and state == 0:
            continue
        total += float(cost[state * 28 + s])
        state = 0 if s == 0 else (state * 28 + s) % 28 ** 3
    return total


def test_viterbi_finds_the_cheapest_path(cost):
    draw = random.Random(3)
    made = ["".join(draw.choice("ie0o1t3s5$!*_ll") for _ in range(draw.randint(2, 6))) for _ in range(60)]
    for stretch, spaced in [*[(m, False) for m in made], ("i d i o t", True), ("a.b-c", True), ("1d10t", False)]:
        paths = [("".join(r for r, _ in path), sum(c for _, c in path))
                 for path in itertools.product(*X.lattice(stretch, spaced))]
        least = min(c + _price(t, cost) for t, c in paths)
        got = X.decode(stretch, cost, spaced)
        assert any(t.strip() == got and c + _price(t, cost) <= least + 1e-6 for t, c in paths)


def test_restores_what_was_written(cost):
    restore = X.Restorer(cost)
    for text, want in (("1d10t", "idiot"), ("m0r0n!", "moron!"), ("you i d i o t", "you idiot"), ("stuuupid", "stupid"),
                       ("cl0wn, $cum", "clown, scum"), ("i.d.i.o.t", "idiot"), ("i_d_i_o_t", "idiot"), ("st*pid", "stupid")):
        assert restore([text]) == [want]
    plain = ["A plain text, in 1990; well-known: 3.14!", "", "a b", "SCUM!!", "ab\n\ncd", "1 2 3 4"]
    assert restore(plain) == plain
    assert restore(plain + ["1d10t"], most=3) == plain + ["idiot"]


def test_a_long_stretch_is_decoded_whole(cost):
    read = X.decode("1d10t" * 20000, cost)  # of mixed letters and digits most are what they look like
    assert read.startswith("idiot") and read.endswith("idiot") and len(read) == 100000
    text = "word " * 200000 + "1d10t"
    assert X.Restorer(cost)([text])[0] == "word " * 200000 + "idiot"


def test_held_out_documents(spark):
    got = Q.op11_toxicity(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    false = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(caught) >= 0.85 * len(caught) and sum(false) <= 0.01 * len(false)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_obfuscated_copies_score_like_the_plain_ones(spark, docs, model):
    plain = docs.filter(F.lower("text").rlike(r"\b(" + "|".join(INSULTS) + r")\b")).select("doc_id", "text").limit(60)
    hidden = plain.withColumn("text", F.regexp_replace(F.translate(F.lower("text"), "oe", "03"), "idi0t", "i d i o t"))
    keep = {"doc_id": F.col("doc_id")}
    a = {r["doc_id"]: r["score"] for r in X.score_toxicity(plain, model, keep).collect()}
    b = {r["doc_id"]: r["score"] for r in X.score_toxicity(hidden, model, keep).collect()}
    caught = [i for i in a if a[i] >= 0.7]
    assert len(caught) >= 0.9 * len(a) and sum(b[i] >= 0.7 for i in caught) >= 0.9 * len(caught)


def test_levels_count_occurrences():
    found = np.array([5, 5, 5, 7, 7, 9])
    assert sorted(X.levelled(found, 100).tolist()) == [5, 7, 9, 105, 107, 205]
    assert X.levelled(np.zeros(0, np.int64), 100).tolist() == []


def test_terms_are_words_and_beginnings():
    def of(*texts):
        out = [Counter() for _ in texts]
        for terms, text_of in X.term_batches(list(texts), 1 << 60):
            for t, i in zip(terms.tolist(), text_of.tolist()):
                out[i][t] += 1
        return out

    a, b, c, d, none = of("Insulting x", "insulted, X", "x/insulting", "x insulting x", "")
    assert a == c and len(a) == 7 and not none  # two words and beginnings of 4 to 8 bytes
    assert len(a & b) == 4 and sum((d - a).values()) == 1  # beginnings of 4 to 6 bytes and x
    assert of("other", "x", "insulting") == of("other", "x", "insulting")


def test_odd_rows(spark, cost):
    schema = "doc_id long, text string, score int, text_ string, k0 string, predicted string"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "bad word"), (4, "bad word"), (None, "bad thing"), (5, "fine"), (6, "1" * 100000)]
    docs = spark.createDataFrame([(*r, 1, "t", "k", "p") for r in rows], schema)
    keep = {"doc_id": F.col("doc_id"), "score_": F.col("score")}
    labels = spark.createDataFrame([(4, 1), (4, None), (5, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    for marks in (labels, labels.filter("false"), labels.filter("toxic = 1")):
        got = X.score_toxicity(docs, X.learn(docs, marks, X.language_model(docs)), keep).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], set()).add(r["score"])
        assert len(by[4]) == 1 and by[1] == by[2] == by[3]
    none = docs.filter("false")
    assert X.score_toxicity(none, X.learn(none, labels, X.language_model(none)), keep).collect() == []
    restored = X.deobfuscate(docs, cost, {"doc_id": F.col("doc_id")}).collect()
    assert {r["doc_id"]: r["restored"] for r in restored}[1] is None
