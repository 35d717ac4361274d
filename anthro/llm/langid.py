"""Language identification by word-first backoff.

A known word scores each language by the log of its relative frequency there.
A word that no language knows is scored by its character n-grams instead: the
longest n of which some gram is known, then n - 1, down to single characters.
A text's score is the mean over its words; the highest language wins, ties go
to the language with more training texts, then by name.

Training reads a bounded sample: about ``max_docs`` texts of each language,
chosen by a hash of the id.  The model holds at most ``max_units`` words and as
many n-grams of each length (fewer with many languages), the most frequent of every
language in equal shares, so what is sent to the workers is bounded whatever the
input.  Words are runs of letters and marks, in training and in use.

Defined results: null text or text without a letter is ``und`` with score 0,
as is every text when nothing could be learned; rows with null id are never
learned from (unless the caller selects them); repeated rows count each; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, row_ranges, stage
from anthro.llm.textnum import Words, byte_table, mix

MAX_DOCS = 2_000
MAX_UNITS = 60_000
MAX_CELLS = 20_000_000     # units times languages
LONGEST = 5
PENALTY = 7.0              # minus log10 of a unit that a language lacks
CACHED_WORDS = 200_000
UNKNOWN = "und"
LETTERS = byte_table({b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)})
_WORD = r"[\p{L}\p{M}]+"     # of a training text;
_BETWEEN = r"[^\p{L}\p{M}]+"  # what is not of a word becomes a blank before a text is judged, so both read the same words


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` characters, from code points."""
    m = max(0, len(codes) - n + 1)
    acc = codes[:m].copy()
    for k in range(1, n):
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc += codes[k:m + k]
    return mix(acc + np.uint64(n))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class Model:
    """Languages, and log10 relative frequencies of words and of n-grams (one row per unit)."""

    def __init__(self, langs: list[str], units: list[tuple[np.ndarray, np.ndarray]]):
        """``units``: hashes and scores, sorted by hash, of words and then of n-grams for n = 1, 2, ..."""
        self.langs = langs
        (self.hashes, self.scores), *self.grams = units
        self._seen: dict[int, np.ndarray] = {}

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of words that are not in the model: the mean over the known n-grams of the longest n that has any."""
        marked = [f" {w} " for w in words]
        codes = code_points("".join(marked))
        size = np.array([len(m) for m in marked])
        start = np.cumsum(size) - size
        out = np.full((len(words), len(self.langs)), -PENALTY, np.float32)
        todo = np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            known, scores = self.grams[n - 1]
            now = todo[size[todo] >= n]
            if not len(now) or not len(known):
                continue
            many = size[now] - n + 1
            word = np.repeat(np.arange(len(now)), many)
            at = start[now][word] + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
            h = gram_hashes(codes, n)[at]
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[place] == h
            word, place = word[hit], place[hit]
            found = np.bincount(word, minlength=len(now))
            some = found > 0
            for k in range(len(self.langs)):
                out[now[some], k] = (np.bincount(word, scores[place, k], len(now))[some] / found[some])
            todo = np.setdiff1d(todo, now[some], assume_unique=True)
        return out

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """A row for each distinct word, and each word's row."""
        distinct, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        out = np.empty((len(distinct), len(self.langs)), np.float32)
        out[known] = self.scores[at[known]]
        new, where = [], []
        for i in np.flatnonzero(~known).tolist():
            row = self._seen.get(int(distinct[i]))
            if row is None:
                new.append(words.word(first[i]).decode())
                where.append(i)
            else:
                out[i] = row
        if new:
            out[where] = self.unseen(new)
            for i in where[:max(0, CACHED_WORDS - len(self._seen))]:
                self._seen[int(distinct[i])] = out[i].copy()
        return out, inverse

    def predict(self, texts: pa.Array) -> tuple[list, np.ndarray]:
        words = Words(texts, LETTERS)
        rows, inverse = self.word_scores(words)
        n = np.maximum(words.count, 1)
        doc = words.doc
        mean = np.stack([np.bincount(doc, rows[inverse, k], len(n)) / n for k in range(len(self.langs))], axis=1)
        best = mean.argmax(axis=1)
        logits = mean * np.log(10) * np.sqrt(n)[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return [self.langs[i] for i in best], (p / p.sum(axis=1, keepdims=True)).max(axis=1)


def _unit_counts(words: DataFrame) -> DataFrame:
    """(size, lang, unit, n): counts of words (size 0) and of n-grams (size n), by hash, from (lang, unit, n); stored."""
    out = "size int, lang string, unit bigint, n bigint"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, n, names = column(b, "lang").to_pylist(), np.asarray(column(b, "n")), column(b, "unit").to_pylist()
            hashes = Words(pa.array(names, pa.string()), LETTERS)
            lang_no = {x: k for k, x in enumerate(sorted(set(langs)))}
            lang = np.array([lang_no[x] for x in langs])
            marked = [f" {x} " for x in names]
            codes = code_points("".join(marked))
            size = np.array([len(m) for m in marked])
            start = np.cumsum(size) - size
            parts = [(0, hashes.hash, hashes.doc)]
            for k in range(1, LONGEST + 1):
                many = np.maximum(size - k + 1, 0)
                word = np.repeat(np.arange(len(size)), many)
                at = start[word] + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
                parts.append((k, gram_hashes(codes, k)[at], word))
            for k, unit, word in parts:
                for name, no in lang_no.items():
                    mine = lang[word] == no
                    u, inverse = np.unique(unit[mine], return_inverse=True)
                    c = np.bincount(inverse, n[word[mine]], len(u)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), k, np.int32)), pa.array([name] * len(u), pa.string()),
                                                      pa.array(u.view(np.int64)), pa.array(c)], schema=arrow)

    return stage(words.mapInArrow(run, out).groupBy("size", "lang", "unit").agg(F.sum("n").alias("n")), "lang-units")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_DOCS, max_units: int = MAX_UNITS) -> Model:
    """Learn from rows with a language and a text; see the module for the bounds."""
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    per_lang = {r.lang: r.n for r in src.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per_lang, key=lambda x: (-per_lang[x], x))
    none = np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32)
    if not langs:
        return Model([], [none] * (LONGEST + 1))
    units = max(100, min(max_units, MAX_CELLS // ((LONGEST + 1) * len(langs))))
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, max_docs / per_lang[x]))) for x in langs])
    chosen = src.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000)
    words = (chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))).alias("unit"))
             .groupBy("lang", "unit").agg(F.count("*").alias("n")))
    counted = _unit_counts(words)
    totals = {(r["size"], r.lang): r.n for r in counted.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    row = counted.groupBy("size", "unit").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n"))).alias(f"n{k}") for k, x in enumerate(langs)])

    # every language keeps as many units, so that small ones do not lose theirs to the counts of large ones
    order = Window.partitionBy("size", "lang").orderBy(F.desc("n"), "unit")
    kept = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= units // len(langs)).select("size", "unit").distinct()
    row = stage(row.join(kept, ["size", "unit"], "left_semi"), "kept-units")

    def top(size: int) -> tuple[np.ndarray, np.ndarray]:
        best = row.where(F.col("size") == size).drop("size").toArrow()  # at most ``units`` rows
        if not best.num_rows:
            return none
        unit = np.asarray(best["unit"]).view(np.uint64)
        score = np.full((len(unit), len(langs)), -PENALTY, np.float32)
        for k, x in enumerate(langs):
            n = np.asarray(best[f"n{k}"].fill_null(0), float)
            score[n > 0, k] = np.maximum(-PENALTY, np.log10(n[n > 0] / totals.get((size, x), 1)))
        order = np.argsort(unit)
        return unit[order], score[order]

    return Model(langs, [top(k) for k in range(LONGEST + 1)])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, predicted language and a score from 0 to 1."""
    out = "doc_id bigint, lang_pred string, score double"
    arrow = arrow_schema(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in row_ranges(batches, "text"):
            lettered = np.asarray(column(b, "lettered").to_numpy(zero_copy_only=False)).astype(bool)
            if m.langs:
                lang, score = m.predict(column(b, "text"))
            else:
                lang, score, lettered = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
            lang = [x if ok else UNKNOWN for x, ok in zip(lang, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(lang), pa.array(np.where(lettered, score, 0.0))], schema=arrow)

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.regexp_replace(F.lower(F.col(text_col).cast("string")), _BETWEEN, " ").alias("text"),
                      F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return src.mapInArrow(run, out)
