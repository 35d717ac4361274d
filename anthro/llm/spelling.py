"""Spelling variant grouping by asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point turns one
into the other.  One word is cut into two disjoint chunks; such an edit touches
one of them at most, so the other stands in the partner as one of its positional
grams, at the same place or shifted by one.  It is enough that the shorter word
(either of two of one length) gives chunks and the longer one grams.

A half word is shared by very many short words, so it is not yet a key: the half
that the edit touches is cut into two chunks again, and again, of which one stays
each time (``CUTS`` cuts).  A key then is all chunks that stayed, that is the word
without one of its 2 ** CUTS smallest pieces, with the piece's number and the
chunk word's length; the partner's keys are its grams at the places that a shift
of at most one allows.  Every pair found is verified by edit distance.

``word_counts`` reads the texts: words are counted by task, then by a shuffle of
the distinct words.  ``near_pairs`` and ``forms`` work on the table of distinct
words; a word has some thousand possible near words at most, so no key grows with
the corpus.  ``roots`` follows forms by pointer doubling.

Defined results: null and empty texts have no words; a null id counts as the
empty string in ``noise``; repeated rows count each; words of equal count rank in
code-point order; words without a form are their own root; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, row_ranges, stage
from anthro.llm.textnum import Words, byte_table, distinct_words

LEAST_LENGTH = 5
LEAST_COUNT = 3
CUTS = 3                  # a key leaves out one of 2 ** CUTS pieces
FORM_RATIO = 2
ROUNDS = 40
BROADCAST_WORDS = 100_000

LETTER_TABLE = byte_table({b for b in range(128) if not chr(b).isalpha()})
_LEAD = 0xC3              # first byte of U+00C0 to U+00FF in UTF-8
_COUNTS = "word string, n bigint"
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _x = _i
    for _ in range(8):
        _x = (_x >> 1) ^ (0xEDB88320 if _x & 1 else 0)
    _CRC[_i] = _x


# ---------------------------------------------------------------- words

def _not_latin(raw: np.ndarray) -> np.ndarray:
    """Bytes of characters other than a-z and U+00C0 to U+00FF."""
    lead = raw == _LEAD
    after = np.zeros(len(raw), bool)
    after[1:] = lead[:-1]
    return (raw >= 128) & ~lead & ~after


def runs_of(texts: pa.Array) -> Words:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case."""
    return Words(texts, LETTER_TABLE, _not_latin)


def crc_after(seed: np.ndarray, words: Words, which: np.ndarray) -> np.ndarray:
    """crc32 of a prefix (its crc32 in ``seed``) followed by each word, one byte of all words at a time."""
    start, size = words.start[which], (words.end - words.start)[which]
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    raw = np.frombuffer(words.data, np.uint8)
    crc = ~seed[order].astype(np.uint32)
    left = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")  # words longer than k
    for k, m in enumerate(left.tolist()):
        crc[:m] = _CRC[(crc[:m] ^ raw[start[:m] + k]) & 0xFF] ^ (crc[:m] >> np.uint32(8))
    out = np.empty(len(crc), np.uint32)
    out[order] = ~crc
    return out


def noise(ids: list, words: Words, modulus: int) -> tuple[np.ndarray, list[str]]:
    """Numbers of the words whose crc32 of ``id:word`` the modulus divides, and these words with code point crc32 % length left out."""
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc_after(np.repeat(prefix, words.count), words, np.arange(len(words.start)))
    hit = np.flatnonzero(crc % np.uint32(modulus) == 0)
    out = []
    for i, c in zip(hit.tolist(), crc[hit].tolist(), strict=True):
        w = words.word(i).decode()
        k = c % len(w)
        out.append(w[:k] + w[k + 1:])
    return hit, out


def word_counts(docs: DataFrame, noise_modulus: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the distinct words long and frequent enough, stored.

    ``noise_modulus``: spelling errors are planted in one of so many occurrences (see ``noise``).
    """
    arrow = arrow_schema(_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_ranges(batches, "text"):
            words = runs_of(column(b, "text"))
            keep = np.ones(len(words.start), bool)
            changed: list[str] = []
            if noise_modulus:
                hit, changed = noise(column(b, "id").to_pylist(), words, noise_modulus)
                keep[hit] = False
            raw = np.frombuffer(words.data, np.uint8)
            leads = np.concatenate([[0], np.cumsum(raw == _LEAD)])
            length = (words.end - words.start) - (leads[words.end] - leads[words.start])
            at = np.flatnonzero(keep & (length >= least_length))
            _, first, n = np.unique(words.hash[at], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([distinct_words(words, at[first]), pa.array(n.astype(np.int64))], schema=arrow)
            changed = [w for w in changed if len(w) >= least_length]
            if changed:
                yield pa.RecordBatch.from_arrays([pa.array(changed, pa.string()), pa.array(np.ones(len(changed), np.int64))], schema=arrow)

    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = src.mapInArrow(run, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return stage(counts.where(F.col("n") >= least_count), "words")


# ---------------------------------------------------------------- near words

def _keys(word: Column, size: Column, extra: int, cuts: int) -> Column:
    """Array of (piece, key): the word without each of the pieces of a word of ``size`` code points.

    ``extra``: code points that the word has beyond ``size``; they fall into the piece.
    """
    pieces = 1 << cuts

    def key(i: Column) -> Column:
        lo, hi = F.shiftright(size * i, cuts), F.shiftright(size * (i + 1), cuts)
        rest = F.concat(F.substring(word, F.lit(1), lo), F.lit("|"), F.substring(word, hi + extra + 1, F.length(word)))
        return F.when((hi > lo) | F.lit(extra > 0), F.struct(i.alias("piece"), rest.alias("key")))

    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), key), lambda x: x.isNotNull())


def near_pairs(words: DataFrame, cuts: int = CUTS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once, stored."""
    sized = words.select("word", "n", F.length("word").alias("size"))
    chunks = sized.select("word", "n", "size", F.explode(_keys(F.col("word"), F.col("size"), 0, cuts)).alias("_k")).select("word", "n", "size", "_k.piece", "_k.key")
    shorter = words.select("word", "n", (F.length("word") - 1).alias("size"))
    grams = shorter.select("word", "n", "size", F.explode(_keys(F.col("word"), F.col("size"), 1, cuts)).alias("_k")).select("word", "n", "size", "_k.piece", "_k.key")
    x = chunks.select("size", "piece", "key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    # of one length: the differing code point lies in one piece only, so a pair comes once
    same = x.join(chunks.select("size", "piece", "key", F.col("word").alias("b"), F.col("n").alias("b_n")), ["size", "piece", "key"]).where((F.col("a") < F.col("b")) & one_edit)
    # a doubled letter may be inserted in either of two pieces
    longer = x.join(grams.select("size", "piece", "key", F.col("word").alias("b"), F.col("n").alias("b_n")), ["size", "piece", "key"]).where(one_edit)
    cols = ["a", "a_n", "b", "b_n"]
    return stage(same.select(*cols).unionByName(longer.select(*cols).dropDuplicates(["a", "b"])), "near-words")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n), stored: the near word of largest count, where that is ``ratio`` times the word's or more."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(best, "word", "left").withColumn("_n", -F.col("best.less"))
    good = F.col("_n") >= ratio * F.col("n")
    return stage(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.near")).alias("form"),
                            F.when(good, F.col("_n")).alias("form_n")), "forms")


def roots(formed: DataFrame, broadcast_words: int = BROADCAST_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """(word, root) of every word with a form: counts rise along forms, so a chain ends; each round doubles the steps taken."""
    now = stage(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    small = now.count() <= broadcast_words
    for _ in range(rounds):
        further = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        joined = now.join(F.broadcast(further) if small else further, F.col("root") == F.col("_w"), "left")
        now = stage(joined.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError(f"forms did not end in {rounds} rounds")


def variants(docs: DataFrame, noise_modulus: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO,
             cuts: int = CUTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = word_counts(docs, noise_modulus, least_length, least_count, id_col, text_col)
    formed = forms(words, near_pairs(words, cuts), ratio)
    return formed.join(roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
