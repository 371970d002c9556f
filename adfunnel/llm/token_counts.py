"""Operator 4: token counts through a digest cache.

A count is stored under two digests: SHA-256 of the normalised content and SHA-256 of the tokenizer's
file and settings.  A run joins the documents' digests to the stored counts, encodes each distinct missing
content once, appends the new counts to the cache and answers from it.  The cache is a Parquet folder
that only grows by committed appends, so a run that dies halfway leaves it valid and the next one
encodes what is still missing.

Content is normalised by cutting white space (space, U+0009-U+000D) at both ends and writing CR LF as LF.
That keeps counts: tokenizers of this kind (``word_bpe_49k.json``) drop white space before the
vocabulary is applied, and none of their special strings holds any.  For the same
reason the pieces between white space are encoded one by one, and each Python process remembers the
counts of the last pieces it saw.  ``split_words=False`` (for tokenizers that keep white space) neither
normalises nor splits.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; special strings inside a text become
special tokens, as the library does by default; repeated rows and copies are encoded once and counted each.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfunnel.session import new_scratch_path

from .common import WS, joined_up, ship_package, whole_text, written


#: Rows of a file of digests or counts, about 100 bytes each.  The tasks that hash or encode texts write no files: such
#: tables would have one for each of them, and on a local disk each makes its executor start two processes (``chmod``),
#: which count as large as the executor until they begin.
_ROWS = 250_000


def tokenizer_version(path: str, split_words: bool = True) -> str:
    """Digest of the tokenizer's file and of the settings that this module encodes with."""
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    settings = json.dumps({"file": body, "add_special_tokens": False, "truncation": None, "padding": None,
                           "split_words": split_words}, sort_keys=True)
    return hashlib.sha256(settings.encode()).hexdigest()


#: Counts of pieces that this Python process has encoded, per tokenizer version: the last ones and those before.
_pieces: dict[str, tuple[dict[str, int], dict[str, int]]] = {}

#: The parts of a tokenizer file with which ``_Lower`` agrees, and the signs that may end a word there.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIGNS = ".,;:!?#*$%&|"


class _Lower:
    """Counts a word of letters and closing signs with the vocabulary alone, about six times faster than the
    whole library call.  Such a word is two pieces to the tokenizer: its letters, lower-cased, their bytes written
    as byte-level symbols, and the signs.  ``count`` says None to any word that might be read otherwise:
    other characters, letters from U+0180 on, those not composed, and the dotted capital I.
    """

    def __init__(self, tok, path: str):
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        normal, pre = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}]
        self.fits = ([n["type"] for n in normal.get("normalizers", [])] == _NORMALIZERS
                     and [p.get("type") for p in steps] == ["Split", "ByteLevel"]
                     and steps[0]["pattern"] == {"Regex": _SPLIT} and steps[0]["invert"]
                     and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
                     and not any(set(t["content"]) <= set(_SIGNS) or t["content"].isalpha()
                                 for t in parts.get("added_tokens", [])))
        self.tok, self.tokenize, self.signs = tok, tok.model.tokenize, {"": 0}
        # byte-level symbols: printable bytes stand for themselves, the others for U+0100 onwards in order
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        self.symbol = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def count(self, word: str) -> int | None:
        stem = word.rstrip(_SIGNS)
        if not self.fits or not stem.isalpha():
            return None
        if stem.isascii():
            low = stem.lower()
        elif max(stem) < "\u0180" and "\u0130" not in stem and unicodedata.is_normalized("NFC", stem):
            low = "".join(self.symbol[b] for b in stem.lower().encode())
        else:
            return None
        signs = word[len(stem):]
        if signs not in self.signs:
            self.signs[signs] = len(self.tok.encode(signs, add_special_tokens=False).ids)
        return len(self.tokenize(low)) + self.signs[signs]


def _count(batches: Iterator[pa.RecordBatch], path: str, version: str, split_words: bool,
           memo: int) -> Iterator[pa.RecordBatch]:
    """Counts tokens; a process remembers between ``memo`` and twice as many pieces from one task to the next."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    fast = _Lower(tok, path)
    young, old = _pieces.setdefault(version, ({}, {}))
    for batch in batches:
        totals = []
        for content in batch.column("content"):
            text = content.as_py()
            if split_words:
                for c in WS[1:]:
                    text = text.replace(c, " ")
            many = Counter(text.split(" ") if split_words else [text])
            many.pop("", None)
            slow = []
            for p in many:
                if p not in young:
                    n = old.get(p)
                    if n is None and split_words:
                        n = fast.count(p)
                    if n is None:
                        slow.append(p)
                    else:
                        young[p] = n
            for at in range(0, len(slow), 10_000):
                part = slow[at:at + 10_000]
                young.update(zip(part, (len(e.ids) for e in tok.encode_batch_fast(part, add_special_tokens=False))))
            totals.append(sum(young[p] * n for p, n in many.items()))
            if len(young) > memo:
                young, old = {}, young
                _pieces[version] = (young, old)
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(totals, pa.int64())],
                                         names=["digest", "n_tokens"])


def stored_counts(spark, cache_path: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer version; empty for a cache that does not exist yet."""
    schema = "digest string, tokenizer string, n_tokens long"
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "digest string, n_tokens long")
    stored = spark.read.schema(schema).parquet(cache_path).filter(F.col("tokenizer") == version)
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, split_words: bool = True,
                 memo: int = 400_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, digest, n_tokens`` per row of ``docs``; the cache at ``cache_path`` grows by
    what was missing.  Without a path the cache is a new folder in the shared scratch folder."""
    spark = docs.sparkSession
    ship_package(spark)
    cache_path = cache_path or new_scratch_path(spark, "token-cache")
    version = tokenizer_version(tokenizer_path, split_words)
    content = whole_text(text_col)
    if split_words:
        content = F.replace(F.btrim(content, F.lit(WS)), F.lit("\r\n"), F.lit("\n"))
    digest = F.sha2(content, 256)
    order = lambda c: F.coalesce(F.col(c), F.lit(-2 ** 63))
    n, files = docs.count(), lambda rows: max(1, -(-rows // _ROWS))
    base = written(docs.select(F.col(id_col).alias("id"), digest.alias("digest"),
                               F.octet_length(whole_text(text_col)).cast("long").alias("n_bytes"))
                   .repartition(files(n)), "token-digests")

    # one document speaks for each missing digest
    missing = written(base.groupBy("digest").agg(F.min(order("id")).alias("ord"))
                      .join(stored_counts(spark, cache_path, version), "digest", "left_anti").coalesce(files(n)),
                      "token-missing")
    texts = docs.select(order(id_col).alias("ord"), digest.alias("digest"), content.alias("content"))
    fresh = (texts.join(missing, ["digest", "ord"], "left_semi").select("digest", "content")
             .mapInArrow(partial(_count, path=tokenizer_path, version=version, split_words=split_words, memo=memo),
                         "digest string, n_tokens long"))
    fresh = fresh.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).coalesce(files(missing.count()))
    (fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(cache_path))
    counts = stored_counts(spark, cache_path, version)
    found = base.join(counts, "digest", "left").select(F.col("id").alias(id_col), "n_bytes", "digest", "n_tokens")
    return joined_up(found, n)
