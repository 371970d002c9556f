"""Hashes of words and word windows for whole Arrow batches, on numpy arrays.

A word (run of bytes other than white space) hashes to the polynomial of its bytes modulo 2^64, taken
from running sums over the bytes, then mixed.  The value depends on the word alone, not on its place or batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}
#: Folded reading: ASCII punctuation separates words too, A-Z count as a-z.
_FOLD_WHITE = _WHITE.copy()
_FOLD_WHITE[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_FOLD_BYTE = _BYTE.copy()
_FOLD_BYTE[65:91] = _BYTE[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, np.uint64(base & _MASK))
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def _hash_words(data: np.ndarray, firsts: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and their first bytes; ``firsts``: where a text begins, so that no word spans two."""
    solid = ~(_FOLD_WHITE if fold else _WHITE)[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = firsts[firsts < len(data)]
    begins[firsts] = solid[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    # a word ends at white space or where the next text begins
    stops = np.append(starts[1:], len(data))
    up, down = _power(len(data))
    values = np.where(solid, (_FOLD_BYTE if fold else _BYTE)[data], np.uint64(0)) * up
    total = np.cumsum(values, dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    # white space counts as 0, so the sum up to the next word's start is the word's own
    return mix((total[stops - 1] - before) * down[starts]), starts


def byte_batches(texts: pa.Array, chunk: int = 1 << 20,
                 most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first text, end text, bytes, where each text begins)`` for runs of about ``chunk`` bytes and at
    most ``most`` texts of an Arrow string array (no nulls)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk, side="right")) - 1)
        end = min(end, n, at + most)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end] - offsets[at]
        at = end


def word_batches(texts: pa.Array, chunk: int = 1 << 20,
                 fold: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first text, end text, word hashes, text of each word)`` for runs of about ``chunk`` bytes."""
    for at, end, data, firsts in byte_batches(texts, chunk):
        hashes, starts = _hash_words(data, firsts, fold)
        yield at, end, hashes, np.searchsorted(firsts, starts, side="right") - 1 + at


def windows(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside a text, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + hashes[i:i + n] + np.uint64(i + 1))
    inside = np.flatnonzero(of[:n] == of[k - 1:])
    return out[inside], inside


def shingles(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle hash, text)``: windows of ``k`` words; a text of fewer words is one shingle."""
    found, first = windows(hashes, of, k)
    texts, where, counts = np.unique(of, return_index=True, return_counts=True)
    short = counts < k
    extra = np.zeros(int(short.sum()), np.uint64)
    for i in range(k - 1):
        there = counts[short] > i
        step = hashes[np.minimum(where[short] + i, len(hashes) - 1)]
        extra = np.where(there, mix(extra + step + np.uint64(i + 1)), extra)
    return np.concatenate([found, mix(extra ^ np.uint64(k))]), np.concatenate([of[first], texts[short]])


def counted(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(hash, text)`` with their counts, sorted by text and then hash."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(of[order], kind="stable")]
    h, t = hashes[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return h[at], t[at], np.diff(np.append(at, len(h)))
