"""Operator 11: toxicity of deobfuscated texts.

A noisy channel is taken to have written the text: letters became look-alike digits or signs, words were
spaced out, letters were repeated or parted by signs.  Each suspicious stretch becomes a lattice whose positions hold the
readings of an observed character with their channel costs, and Viterbi decoding finds the cheapest path under
a character language model of order 4 whose counts cover all documents.  The restored text is then scored.

Only stretches with more than one reading are decoded: words with look-alikes or parting signs inside, words with a letter three
times running, and three or more single characters in a row.  All other text has one reading and stays.

The score is a noisy-or: every telling term of the restored text (a word, or the beginning of one) makes the label 1 with
a probability of its own, again if it occurs twice or three times, and a leak covers what no term explains.  Terms enter by likelihood, so that one which only
keeps company with a telling one, or comes from a group of copies, is explained away.

Learning reads a bounded sample: the ``per_label`` distinct texts of least hash for each label (copies count once, with the mean of
their labels), ``n_terms`` terms of greatest association.  The driver holds at most ``2 * per_label * n_terms`` term
numbers and ``28 ** 4`` counts, whatever the size of the corpus; the language model's counts grow with it.

Defined cases: a null, empty or wordless text has the leak as its score; without labelled rows every score is 0;
with one label only the score is the leak; rows with a null label, or whose id has no label, teach the language model alone;
an id labelled more than once counts with the mean; equal texts get equal scores; other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import ship_package, whole_text, written

#: Symbols of the language model: 0 ends a word, 1 to 26 are a to z, 27 is any other letter or digit.
SYMBOLS, OTHER = 28, 27
CONTEXTS = SYMBOLS ** 3
#: Letters that a sign may stand for; a star may hide a vowel.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "*": "aeiou",
}
#: Signs that may be put between the letters of a word, and those that part spaced-out letters.
PARTING, SPACING = "*_~", " .-"
#: Signs that count inside a word only.
INNER = "!|+*_~"
#: Channel costs (negative logs): a letter written as a look-alike, a sign put in, a letter doubled, a space put in or a real one.
SWAP, PUT_IN, DOUBLED, SPACED, REAL_SPACE = 2.3, 3.0, 6.0, 0.7, 0.7
#: A term says that a word or beginning occurs at least once, twice, three times.
LEVELS = 3
#: Flags of characters: part of a stretch, letter, sign, space between spaced-out letters.
UNIT, LETTER, SIGN, SPACE = 1, 2, 4, 8


def _symbol(c: str) -> int:
    """The symbol of a character: accents and width are folded; 0 for what no word holds."""
    base = unicodedata.normalize("NFKD", c.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return OTHER if c.isalnum() else 0


_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    """Of each of the first 65,536 code points the symbol, the flags or the lower case."""
    if not _tables:
        chars = ["" if 0xD800 <= i < 0xE000 else chr(i) for i in range(1 << 16)]
        signs = set(LOOKALIKES) | set(INNER)
        _tables["symbol"] = np.array([_symbol(c) if c else 0 for c in chars], np.uint8)
        _tables["flags"] = np.array(
            [0 if not c else UNIT | SIGN if c in signs or c.isdigit() else UNIT | LETTER if c.isalnum()
             else SPACE if c in SPACING else 0 for c in chars], np.uint8)
        _tables["lower"] = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32)
    return _tables[name]


def stretches(text: str) -> list[tuple[int, int, bool]]:
    """``(start, end, spaced out)`` of the suspicious stretches of a text, in order.

    A run is a longest sequence of letters, digits and signs.  Three or more one-character runs, one space, dot or
    hyphen apart and with two letters among them, are a spaced-out stretch; any other run is one if it holds a letter and a sign
    (signs of ``INNER`` not at its ends) or a letter three times running."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.minimum(codes, 0xFFFF)
    flags = np.where(codes < 1 << 16, _table("flags")[known], 0)
    unit = np.concatenate([[False], (flags & UNIT) > 0, [False]])
    edges = np.flatnonzero(unit[1:] != unit[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return []
    low = _table("lower")[known]
    letter = (flags & LETTER) > 0
    triple = np.zeros(len(codes), bool)
    if len(codes) > 2:
        triple[:-2] = letter[:-2] & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])

    def inside(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[ends] > total[starts]

    odd = inside(triple) | (inside(letter) & inside((flags & SIGN) > 0))
    single = ends - starts == 1
    gap = np.zeros(len(starts), bool)  # whether the run joins the one before it
    gap[1:] = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1)
    gap[1:] &= (flags[np.maximum(starts[1:] - 1, 0)] & SPACE) > 0
    new = np.flatnonzero(~gap)
    lengths = np.diff(np.append(new, len(starts)))
    chains = [(int(starts[f]), int(ends[f + n - 1]), True) for f, n in zip(new, lengths) if n >= 3] \
        if (lengths >= 3).any() else []
    out = [c for c in chains if sum(x.isalpha() for x in text[c[0]:c[1]]) >= 2]
    for a, b in zip(starts[odd].tolist(), ends[odd].tolist()):
        core = text[a:b].lstrip(INNER)
        a, core = b - len(core), core.rstrip(INNER)
        if any(c in LOOKALIKES or c in INNER or c.isdigit() for c in core) and any(map(str.isalpha, core)) \
                or triple[a:a + len(core)].any():
            out.append((a, a + len(core), False))
    return sorted(out)


def ngram_cells(texts: list[str], piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """Cells ``(three symbols before, symbol)`` of all symbols of the texts, word ends included; what lies
    before a word's beginning counts as 0."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes) + 1, piece):
        part = codes[max(0, at - 3):at + piece]
        x = np.where(part < 1 << 16, _table("symbol")[np.minimum(part, 0xFFFF)], OTHER).astype(np.int64)
        lead = np.zeros(3 - min(at, 3), np.int64)
        tail = np.zeros(1 if at + piece > len(codes) else 0, np.int64)  # the last text ends a word
        x = np.concatenate([lead, x, tail])
        a, b, c, d = x[:-3], x[1:-2], x[2:-1], x[3:]
        b = np.where(c == 0, 0, b)
        a = np.where(b == 0, 0, a)
        yield (((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d)[(c > 0) | (d > 0)]


def _cell_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS ** 4, np.int64)
    for batch in batches:
        texts = batch.column("text")
        for at in range(0, len(texts), 256):
            for cells in ngram_cells(texts.slice(at, 256).to_pylist()):
                total += np.bincount(cells, minlength=len(total))
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["cell", "n"])


def language_model(docs: DataFrame, text_col: str = "text", weight: float = 4.0) -> np.ndarray:
    """Negative log probabilities of a symbol after three, over all texts; each order is smoothed by the one below."""
    ship_package(docs.sparkSession)
    counted = (docs.select(whole_text(text_col).alias("text")).mapInArrow(_cell_counter, "cell int, n long")
               .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())  # at most 28 ** 4 rows
    counts = np.zeros(SYMBOLS ** 4)
    counts[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    return smoothed(counts.reshape((SYMBOLS,) * 4), weight)


def smoothed(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Flat negative logs from counts of four symbols."""
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, 5):
        n = counts.sum(axis=tuple(range(4 - order)))
        p = (n + weight * p) / (n.sum(axis=-1, keepdims=True) + weight)
    return -np.log(p).astype(np.float32).reshape(-1)


def lattice(stretch: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """The readings of each position: a run of one character, lower-cased.  A space ends a word, an
    empty reading writes nothing.  Three and more of a letter are one or two of it."""
    low, out, at = stretch.lower(), [], 0
    while at < len(low):
        c, end = low[at], at + 1
        while end < len(low) and low[end] == c and not spaced:
            end += 1
        many = end - at
        if spaced and at % 2:
            out.append([("", SPACED), (" ", REAL_SPACE)])
        elif _symbol(c) in (0, OTHER):
            kept = low[at:end] if _symbol(c) else " "
            reads = [(kept, 0.0)] + [(x * k, SWAP + DOUBLED * (k < many)) for x in LOOKALIKES.get(c, "")
                                     for k in range(1, min(many, 2) + 1)]
            out.append(reads if _symbol(c) and c not in PARTING else reads + [("", PUT_IN)])
        else:
            out.append([(c * k, DOUBLED * (k < many)) for k in range(min(many, 2), 0, -1)])
        at = end
    return out


def _step(cost: np.ndarray, state: int, reading: str) -> tuple[float, int]:
    total = 0.0
    for c in reading:
        s = _symbol(c)
        if s == 0 and state == 0:
            continue
        total += float(cost[state * SYMBOLS + s])
        state = 0 if s == 0 else (state * SYMBOLS + s) % CONTEXTS
    return total, state


def decode(stretch: str, cost: np.ndarray, spaced: bool = False) -> str:
    """The cheapest reading of a stretch; of equally cheap ones the first in lattice order.  Memory grows with the
    stretch by a few bytes for each state."""
    positions = lattice(stretch, spaced)
    states: dict[int, tuple[float, int]] = {0: (0.0, 0)}  # state -> cost, place among the states
    came, starts = array("H"), array("Q")  # place of the state before and reading taken, for each state of each position
    steps: dict[tuple[int, str], tuple[float, int]] = {}
    for readings in positions:
        new: dict[int, tuple[float, int, int]] = {}
        for state, (paid, place) in states.items():
            for k, (reading, channel) in enumerate(readings):
                if (state, reading) not in steps:
                    steps[state, reading] = _step(cost, state, reading)
                more, to = steps[state, reading]
                total = paid + channel + more
                if to not in new or total < new[to][0]:
                    new[to] = (total, place, k)
        starts.append(len(came))
        for _, place, k in new.values():
            came.extend((place, k))
        states = {s: (v[0], i) for i, (s, v) in enumerate(new.items())}
    place = min(states.items(), key=lambda x: x[1][0] + _step(cost, x[0], " ")[0])[1][1]
    read = []
    for at in range(len(positions) - 1, -1, -1):
        place, k = came[starts[at] + 2 * place], came[starts[at] + 2 * place + 1]
        read.append(positions[at][k][0])
    return "".join(reversed(read)).strip()


class Restorer:
    """Restores texts; readings of short stretches are kept, a bounded number of them."""

    def __init__(self, cost: np.ndarray, kept: int = 1 << 16):
        self.cost, self.kept, self.known = cost, kept, {}

    def read(self, stretch: str, spaced: bool) -> str:
        got = self.known.get((stretch, spaced))
        if got is None:
            got = decode(stretch, self.cost, spaced)
            if len(stretch) <= 32:
                if len(self.known) >= self.kept:
                    self.known.clear()
                self.known[stretch, spaced] = got
        return got

    def __call__(self, texts: list[str], most: int = 1 << 20) -> list[str]:
        """The restored texts; some are looked through together, about ``most`` characters at a time."""
        out, at = [], 0
        while at < len(texts):
            size, end = len(texts[at]), at + 1
            while end < len(texts) and size + len(texts[end]) <= most:
                size += len(texts[end]) + 1
                end += 1
            out += self._restored(texts[at:end])
            at = end
        return out

    def _restored(self, texts: list[str]) -> list[str]:
        joined = "\n".join(texts)  # no stretch goes over a line end
        found, k, first, out = stretches(joined), 0, 0, []
        for text in texts:
            parts, at = [], first
            while k < len(found) and found[k][0] < first + len(text):
                a, b, spaced = found[k]
                parts += [joined[at:a], self.read(joined[a:b], spaced)]
                at, k = b, k + 1
            out.append("".join([*parts, joined[at:first + len(text)]]) if parts else text)
            first += len(text) + 1
        return out


@dataclass
class Model:
    """``cost``: the language model; ``terms``: term buckets, sorted, that speak for label 1 with ``p`` each."""
    cost: np.ndarray
    terms: np.ndarray
    p: np.ndarray
    leak: float
    buckets: int


def term_batches(texts: list[str], buckets: int, prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)) \
        -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(term buckets, text of each)``: a term is a word or the first bytes of a longer one, so that
    inflected forms share terms.  Words are parted by ASCII punctuation too, A-Z counts as a-z."""
    for at, end, data, firsts in hashing.byte_batches(pa.array(texts, pa.string())):
        solid = _WORD_BYTES[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        begins[firsts[firsts < len(data)]] = solid[firsts[firsts < len(data)]]
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        # a word ends before the next byte that is no part of one, or before the next text
        stops = np.flatnonzero(np.concatenate([~solid, [True]]))
        ends = np.minimum(stops[np.searchsorted(stops, starts)], np.append(starts[1:], len(data)))
        low = hashing.mix(_LOWER_BYTES[data].astype(np.uint64))
        of = np.searchsorted(firsts, starts, side="right") - 1 + at
        running = np.concatenate([[np.uint64(0)], np.cumsum(low * _odd_powers(len(low)), dtype=np.uint64)])
        back = _odd_powers(len(low), inverse=True)[starts]
        for length in (*prefixes, 0):
            there = (ends - starts > length) if length else np.ones(len(starts), bool)
            upto = starts[there] + length if length else ends
            value = hashing.mix((running[upto] - running[starts[there]]) * back[there] + np.uint64(length))
            yield (value % np.uint64(buckets)).astype(np.int64), of[there]


def _odd_powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd number, or of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    steps = np.full(n, np.uint64(pow(base, -1, 1 << 64) if inverse else base))
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


_LOWER_BYTES = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def levelled(found: np.ndarray, buckets: int) -> np.ndarray:
    """Terms of one text from the buckets of its words: that a bucket occurs, occurs twice, three times or more."""
    bucket, n = np.unique(found, return_counts=True)
    return np.concatenate([bucket[n > level] + level * buckets for level in range(LEVELS)])


def _sample_terms(cost: np.ndarray, buckets: int) -> Callable:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(cost)
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                terms = [t for t, _ in term_batches(restore([text]), buckets)]
                terms = levelled(np.concatenate(terms) if terms else np.zeros(0, np.int64), buckets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(i, 1), batch.column("share").slice(i, 1),
                     pa.array([terms.astype(np.int32)], pa.list_(pa.int32()))], names=["key", "share", "terms"])

    return make


def fit_noisy_or(present: np.ndarray, share: np.ndarray, weight: np.ndarray, least_gain: float = 8.0,
                 rounds: int = 30) -> tuple[np.ndarray, float]:
    """Probabilities of the terms (columns of ``present``) and the leak, for rows of label 1 by ``share``.

    Terms enter one by one, each time the one that raises the log likelihood most, while it rises by ``least_gain``;
    so of terms that keep company one is taken.  Then expectation-maximisation: the credit of a row's label 1 is dealt to its
    terms and the leak, and a term's probability is its credit over its rows, with half a row against it."""
    x = present.astype(np.float64)
    weight = weight / max(weight.mean(), 1e-12)
    p, rows = np.zeros(x.shape[1]), x.T @ weight
    leak = float(np.clip((weight * share).sum() / max(weight.sum(), 1e-12), 1e-4, 0.5))
    trials = (0.5, 0.8, 0.95, 0.99)
    for _ in range(x.shape[1]):
        quiet = (1 - leak) * np.exp(x @ np.log1p(-p))
        gains = np.stack([x.T @ (weight * (share * np.log((1 - quiet * (1 - t)) / (1 - quiet)) + (1 - share) * np.log1p(-t)))
                          for t in trials])
        gains[:, p > 0] = -np.inf
        best = int(gains.max(axis=0).argmax())
        if gains[:, best].max() < least_gain:
            break
        p[best] = trials[int(gains[:, best].argmax())]
        free = weight * (x[:, p > 0].sum(axis=1) == 0)
        leak = float(np.clip(((free * share).sum() + 0.5) / (free.sum() + 1), 1e-4, 0.5))
    for _ in range(rounds):
        quiet = (1 - leak) * np.exp(x @ np.log1p(-p))
        credit = weight * share / np.maximum(1 - quiet, 1e-12)
        p = np.where(p > 0, np.clip(p * (x.T @ credit) / (rows + 0.5), 0, 0.999), 0.0)
        leak = float(np.clip((leak * credit.sum() + 0.5) / (weight.sum() + 1), 1e-4, 0.5))
    return p, leak


def learn(docs: DataFrame, labels: DataFrame, cost: np.ndarray, per_label: int = 4000, n_terms: int = 1000,
          buckets: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the texts of ``docs`` that ``labels`` marks by id, at most ``per_label`` of either label."""
    empty = Model(cost, np.zeros(0, np.int64), np.zeros(0), 0.0, buckets)
    ship_package(docs.sparkSession)
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .filter("id is not null and label is not null"))
    # ids and digests are joined, not texts; copies of a text become one row with the mean of their labels
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("key"))
    texts = keyed.join(marks, "id").groupBy("key").agg(F.avg("label").alias("share")) \
        .withColumn("one", F.col("share") >= 0.5)
    texts = written(texts, "labelled-texts")
    sizes = {r["one"]: r["n"] for r in texts.groupBy("one").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return empty
    parts = [texts.filter(F.col("one") == one).orderBy("key").limit(per_label) for one in sorted(sizes)]
    chosen = written(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "sample-keys")
    # at most 2 * per_label narrow rows
    found = (docs.select(whole_text(text_col).alias("text"), F.xxhash64(whole_text(text_col)).alias("key"))
             .join(F.broadcast(chosen.select("key", "share")), "key").dropDuplicates(["key"]))
    sample = written(found.select("key", "share", "text")
                     .mapInArrow(_sample_terms(cost, buckets), "key long, share double, terms array<int>"), "sample")
    each = sample.select("key", "share", F.explode("terms").alias("term"))
    n_one = min(per_label, sizes.get(True, 0))
    n_all = n_one + min(per_label, sizes.get(False, 0))
    by = each.groupBy("term").agg(F.sum(F.when(F.col("share") >= 0.5, 1).otherwise(0)).alias("k"),
                                  F.count(F.lit(1)).alias("n"))
    # the association of term and label, signed: a normal score with the share expected of all terms
    e = F.col("n") * F.lit(n_one / n_all)
    z = (F.col("k") - e) / F.sqrt(e * F.lit(max(1 - n_one / n_all, 1e-9)) + 1e-9)
    best = by.filter("n >= 4").withColumn("z", z).filter("z > 0").orderBy(F.desc("z"), "term").limit(n_terms)
    terms = np.array(sorted(r["term"] for r in best.select("term").collect()), np.int64)
    rows = sample.select("share", F.array_intersect("terms", F.array(*[F.lit(int(t)) for t in terms])
                         if len(terms) else F.array().cast("array<int>")).alias("terms")).toArrow()
    share = rows.column("share").to_numpy()
    present = np.zeros((len(share), len(terms)), bool)
    held = rows.column("terms").combine_chunks()
    of = np.repeat(np.arange(len(share)), np.asarray(held.value_lengths()))
    present[of, np.searchsorted(terms, held.flatten().to_numpy())] = True
    # the sample may hold more of one label than the corpus does
    one = share >= 0.5
    weight = np.where(one, sizes.get(True, 0) / max(1, int(one.sum())), sizes.get(False, 0) / max(1, int((~one).sum())))
    p, leak = fit_noisy_or(present, share, weight)
    spoken = p > 0
    return Model(cost, terms[spoken], p[spoken], leak, buckets)


def _scorer(model: Model) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.cost)
        bases = np.unique(model.terms % model.buckets)
        where = np.full(model.buckets, -1, np.int64)
        where[bases] = np.arange(len(bases))
        quiet = np.zeros((LEVELS + 1, len(bases)))  # by occurrences, all lower levels included
        quiet[model.terms // model.buckets + 1, where[model.terms % model.buckets]] = np.log1p(-model.p)
        quiet = np.cumsum(quiet, axis=0)
        for batch in batches:
            column, scores = batch.column("text"), []
            for at in range(0, len(column), 64):
                texts = restore(column.slice(at, 64).to_pylist())
                silent = np.full(len(texts), math.log1p(-model.leak))
                pairs = []
                for terms, of in term_batches(texts, model.buckets):
                    k = where[terms]
                    pairs.append(of[k >= 0] * max(1, len(bases)) + k[k >= 0])
                if pairs:
                    pair, n = np.unique(np.concatenate(pairs), return_counts=True)
                    np.add.at(silent, pair // max(1, len(bases)), quiet[np.minimum(n, LEVELS), pair % max(1, len(bases))])
                scores.append(-np.expm1(silent))
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(scores) if scores else np.zeros(0)), *columns],
                                             names=["score", *batch.schema.names[1:]])

    return score


def _restorer(cost: np.ndarray) -> Callable:
    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(cost)
        for batch in batches:
            texts = [None if t is None else restore([t])[0] for t in batch.column("text").to_pylist()]
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *columns],
                                             names=["restored", *batch.schema.names[1:]])

    return restored


def _mapped(docs: DataFrame, text: Column, make: Callable, out: str, keep: dict[str, Column]) -> DataFrame:
    ship_package(docs.sparkSession)
    fed = docs.select(text.alias("text"), *[v.alias(f"k{i}") for i, v in enumerate(keep.values())])
    kinds = "".join(f", k{i} {fed.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    got = fed.mapInArrow(make, out + kinds)
    return got.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], out.split()[0])


def deobfuscate(docs: DataFrame, cost: np.ndarray, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``restored``, the restored text (null: null); one pass, no shuffle."""
    return _mapped(docs, F.col(text_col), _restorer(cost), "restored string", keep)


def score_toxicity(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score`` for every row; one pass, no shuffle."""
    return _mapped(docs, whole_text(text_col), _scorer(model), "score double", keep)
