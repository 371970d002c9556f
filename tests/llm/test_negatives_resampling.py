"""Hard negatives and importance resampling against brute force, on odd rows and over several blocks."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfunnel.llm import negatives, resampling

SF = "/root/testdata/sf0.001"
FOUND = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_negatives(rows, is_anchor, n_pos=5, n_neg=10, low=30, high=90):
    def usable(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[1])

    table = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in filter(usable, rows)]
    anchors = {}
    for i, v, c in table:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (c, v)), (c, v))
    out = []
    for a, (label, vector) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, c) for i, v, c in table
                        if i != a and len(v) == len(vector))
        for p, pid, _ in [s for s in scored if s[2] == label][:n_pos]:
            fit = [(-s, i) for s, i, c in scored if c != label and low * -p <= 100 * -s <= high * -p][:n_neg]
            out += [(a, pid, k + 1, i, -p, s) for k, (s, i) in enumerate(fit)]
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [16 << 20, 400])
def test_negatives(spark, block_bytes):
    draw = random.Random(5)
    vector = [[draw.choice([-1.0, -0.25, 0.0, 0.3, 0.5, 1.0]) for _ in range(4)] for _ in range(12)]  # many ties
    rows = [(i, draw.choice(vector), draw.randrange(3)) for i in range(300)]
    rows += [(300, None, 1), (301, [0.1, None, 0.2, 0.3], 1), (302, [0.1, float("nan"), 0.2, 0.3], 1), (7, vector[0], None),
             (None, vector[1], 1), (303, [float("inf"), 0.0, 0.0, 0.0], 0), (10, vector[2], 0), (10, vector[2], 0),
             (304, [1.0, 2.0], 0), (310, [1.0, 1.0], 0), (311, [1.0, 1.0], 1), (306, [1.0, 1.5], 1), (320, [], 0), (321, [], 1), (322, [], 0)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "vec_id long, embedding array<double>, label int, __label string, id string").repartition(5)
    got = negatives.mine_negatives(frame, F.col("vec_id") % 10 == 0, F.col("label"), block_bytes=block_bytes).collect()
    assert Counter(tuple(r) for r in got) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_a_table_and_of_none(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    got = negatives.mine_negatives(frame, F.col("vec_id") % 100 == 0, F.col("label")).collect()
    assert Counter(tuple(r) for r in got) == brute_negatives(rows, lambda i: i % 100 == 0) and got
    for nothing in (frame.filter("false"), frame.filter("vec_id % 100 = 1")):
        out = negatives.mine_negatives(nothing, F.col("vec_id") % 100 == 0, F.col("label"))
        assert out.collect() == [] and out.columns == list(FOUND)


def test_scores_beyond_double_precision(spark):
    big = [(i, [float(2 ** 20 + i), 2.0 ** 21 + 3 * i, 1.0], i % 2) for i in range(0, 40)]
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    got = negatives.mine_negatives(frame, F.col("vec_id") % 20 == 0, F.col("label"), low=0, high=100).collect()
    assert Counter(tuple(r) for r in got) == brute_negatives(big, lambda i: i % 20 == 0, low=0, high=100) and got
    huge = spark.createDataFrame([(i, [1e300, -1e300], i % 2) for i in range(4)], "vec_id long, embedding array<double>, label int")
    negatives.mine_negatives(huge, F.col("vec_id") == 0, F.col("label")).collect()  # held at the end of 64 bits


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_resample(docs, target, percent=25, min_words=20, max_n=2, buckets=10000, seed=7):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1)
                        for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)}
    out = []
    for i, text in docs:
        n, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = list(range(1, len(able) * percent // 100 + 1))
    drawn = [(*r, k) for k, r in zip(ranks, able)]
    rest = list((Counter(out) - Counter(r[:5] for r in drawn)).elements())
    return Counter([*drawn, *[(*r, None) for r in rest]])


LONG = " ".join(f"word{i} Ünï" for i in range(3000))
ODD = [(1, None), (2, ""), (3, " \n"), (4, LONG), (4, LONG), (4, LONG), (None, LONG), (None, LONG), (5, "a" * 3000000),
       (6, "One word\x00two,Three"), (7, "日本 é́ x"), (8, LONG + " tail")]


@pytest.mark.parametrize("max_n,buckets", [(2, 10000), (3, 50), (1, 7)])
def test_resample(spark, max_n, buckets):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in base.collect()] + ODD
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score int, bucket string").repartition(5)
    want = brute_resample(rows, [r["text"] for r in target.collect()], max_n=max_n, buckets=buckets)
    got = resampling.resample(frame, target, max_n=max_n, buckets=buckets).collect()
    assert Counter(tuple(r) for r in got) == want


def test_resample_of_nothing(spark):
    schema = "doc_id long, text string"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(i, "a b c " * 10) for i in range(8)], schema)
    assert resampling.resample(none, some).collect() == []
    got = resampling.resample(some, none).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]


def test_blocks_do_not_change_features():
    text = ("ab cd  ef,gh " * 50).encode()
    def whole(size):
        out = {1: [], 2: [], 3: []}
        resampling.word_blocks.__defaults__ = (size,)
        try:
            for n, crcs in resampling.ngram_crcs(text, 3):
                out[n] += crcs
        finally:
            resampling.word_blocks.__defaults__ = (1 << 20,)
        return out

    assert whole(1 << 20) == whole(5) == whole(1)
