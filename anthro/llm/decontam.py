"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores, for every shard of about a megabyte of training text,
each term's sorted list of positions (one row per shard, Parquet in the shared
folder).  The index is split by document, so no term, however frequent, gathers
its postings in one task.

``phrase_hits`` finds every exact occurrence of every benchmark window: it
starts from the positions of the window's rarest term in the shard and
intersects them with the other terms' lists, shifted by their offsets, rarest
first.  ``proximity_hits`` finds the documents in which all words of an item
occur within a span of words.

The benchmark is read in blocks of at most ``block_bytes`` of text; a block is
what a task holds beside one shard.  Terms are compared by 64-bit hashes.

Defined results: null or empty text has no words and no hits; null document
ids are kept as rows; repeated rows count each; an empty benchmark hits
nothing; a benchmark row with a null ``item_id`` contaminates but is left out
of the item list; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, give_back, record_batch, row_ranges, stage
from anthro.llm.textnum import ALNUM_TABLE, Words, slices

WINDOW = 13
BLOCK_BYTES = 32 << 20
MOST_WINDOWS = 20_000     # windows opened at once,
MOST_POSITIONS = 500_000  # and positions of their rarest words
BROADCAST_KEYS = 1_000_000

INDEX_SCHEMA = "shard string, doc_ids array<bigint>, first binary, terms binary, counts binary, positions binary"
RESULT_SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, "
                 "items_sha256 string, contaminated boolean")
MATCH_SCHEMA = "doc_id bigint, item_id string, start bigint, length bigint"


# ---------------------------------------------------------------- index

def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional postings of ``docs``, one row per shard, stored in the shared folder."""
    arrow = arrow_schema(INDEX_SCHEMA)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(row_ranges(batches, "text")):
            w = Words(column(b, "text"), ALNUM_TABLE)
            order = np.argsort(w.hash, kind="stable")
            terms, counts = _runs(w.hash[order])
            yield record_batch([(f"{part}-{n}", column(b, "id").to_pylist(), w.first.astype("<u4").tobytes(), terms.astype("<u8").tobytes(),
                                 counts.astype("<u4").tobytes(), order.astype("<u4").tobytes())], arrow)

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stage(src.mapInArrow(shards, INDEX_SCHEMA), "positional-index")


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    if not len(ordered):
        return ordered, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[at], np.diff(np.concatenate([at, [len(ordered)]]))


class Shard:
    """One row of the index, opened."""

    def __init__(self, row: dict):
        self.name = row["shard"]
        self.doc_ids = row["doc_ids"]
        self.first = np.frombuffer(row["first"], "<u4").astype(np.int64)
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self.n = len(self.positions)
        self._keys: np.ndarray | None = None

    def holds(self, term_no: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether the posting list of each term has the position."""
        if self._keys is None:  # (term, position) pairs are in order: one sorted array of all lists
            self._keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.n + self.positions
        q = term_no * self.n + position
        i = np.minimum(np.searchsorted(self._keys, q), self.n - 1)
        return (position >= 0) & (position < self.n) & (self._keys[i] == q)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1


# ---------------------------------------------------------------- benchmark

class Block:
    """Some benchmark items: their words one after the other, and windows as places in them.

    ``terms``: distinct words; ``term_of``: number of each word in ``terms``;
    ``first``: place of each item's first word (one more entry at the end);
    ``start``/``length``: place and size of each window.
    """

    def __init__(self, item_ids: list, texts: list, window: int):
        self.items = item_ids
        texts = pa.array(texts, pa.string())
        parts = [(w.hash, w.count) for w in (Words(texts.slice(lo, hi - lo), ALNUM_TABLE) for lo, hi in slices(texts))]
        self.terms, self.term_of = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for h, _ in parts]]), return_inverse=True)
        self.term_of = self.term_of.astype(np.int32)
        count = np.concatenate([np.zeros(0, np.int64), *[c for _, c in parts]])
        self.first = np.concatenate([[0], np.cumsum(count)])
        size = np.minimum(window, count)
        many = np.where(size > 0, count - size + 1, 0)
        self.start = (np.arange(int(many.sum())) + np.repeat(self.first[:-1] - (np.cumsum(many) - many), many)).astype(np.int32)
        self.length = np.repeat(size, many).astype(np.int16)

    def numbers(self, shard: Shard) -> np.ndarray:
        """Number of each distinct word in the shard, -1 where it does not occur."""
        no = np.full(len(self.terms) + 1, -1, np.int32)
        if len(self.terms) and len(shard.terms):
            at = np.searchsorted(self.terms, shard.terms)
            same = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == shard.terms)
            no[at[same]] = same
        return no

    def occurrences(self, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item row, start position, length) of every occurrence of every window in one document."""
        no = self.numbers(shard)
        absent = np.concatenate([np.zeros(1, np.int32), np.cumsum(no[self.term_of] < 0, dtype=np.int32)])
        whole = np.flatnonzero(absent[self.start + self.length] == absent[self.start])
        found = [(np.zeros(0, np.int64),) * 3]
        for n in np.unique(self.length[whole]).tolist():
            windows = whole[self.length[whole] == n]
            for lo in range(0, len(windows), MOST_WINDOWS):
                found += self._intersect(shard, no, self.start[windows[lo:lo + MOST_WINDOWS]].astype(np.int64), n)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _intersect(self, shard: Shard, no: np.ndarray, place: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of ``n`` words at ``place``, all of whose words the shard has: lists met from the rarest word on."""
        terms = no[self.term_of[place[:, None] + np.arange(n)]].astype(np.int64)
        by_rarity = np.argsort(shard.counts[terms], axis=1, kind="stable")
        rarest = np.take_along_axis(terms, by_rarity[:, :1], axis=1)[:, 0]
        many = shard.counts[rarest]
        ends = np.cumsum(many)
        lo = 0
        while lo < len(place):  # so many windows that their rarest words have a bounded number of positions
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - many[lo] + MOST_POSITIONS, "right")))
            m = many[lo:hi]
            win = np.repeat(np.arange(lo, hi), m)
            inside = np.arange(len(win)) - np.repeat(np.cumsum(m) - m, m)
            start = shard.positions[shard.at[rarest[win]] + inside] - by_rarity[win, 0]
            for k in range(1, n):
                offset = by_rarity[win, k]
                keep = shard.holds(terms[win, offset], start + offset)
                win, start = win[keep], start[keep]
            keep = (start >= 0) & (start + n <= shard.n)
            win, start = win[keep], start[keep]
            keep = shard.doc_of(start) == shard.doc_of(start + n - 1)
            yield np.searchsorted(self.first, place[win[keep]], "right") - 1, start[keep], np.full(int(keep.sum()), n)
            lo = hi


def _blocks(bench: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[Block]:
    src = bench.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // block_bytes
    for k in range(n):
        part = src if n == 1 else src.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n)).isin(2 * k, 2 * k + 1))
        rows = part.collect()  # one block: about block_bytes
        yield Block([r.item_id for r in rows], [r.text for r in rows], window)


# ---------------------------------------------------------------- searches

def _over_shards(index: DataFrame, block: Block, each: Callable[[Shard, Block], list[tuple]], schema: str) -> DataFrame:
    arrow = arrow_schema(schema)
    sent = index.sparkSession.sparkContext.broadcast(block)  # at most a block of benchmark text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = each(Shard({f: column(b, f)[i].as_py() for f in b.schema.names}), sent.value)
                if rows:
                    yield record_batch(rows, arrow)
            del b
        give_back()

    return index.mapInArrow(run, schema)


def phrase_hits(index: DataFrame, bench: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per occurrence: doc_id, item_id, start (word number in the document), length."""
    out = None
    for block in _blocks(bench, id_col, text_col, window, block_bytes):
        def each(shard: Shard, block: Block) -> list[tuple]:
            item, start, length = block.occurrences(shard)
            doc = shard.doc_of(start)
            return [(shard.doc_ids[d], block.items[i], int(s - shard.first[d]), int(n))
                    for d, i, s, n in zip(doc, item, start, length, strict=True)]

        part = _over_shards(index, block, each, MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def proximity_hits(index: DataFrame, bench: DataFrame, span: int, id_col: str = "item_id",
                   text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with all distinct words of an item inside ``span`` consecutive words.

    One row per (document, item): start and length of the first shortest such run.
    """
    out = None
    for block in _blocks(bench, id_col, text_col, WINDOW, block_bytes):
        def each(shard: Shard, block: Block) -> list[tuple]:
            rows = []
            numbers = block.numbers(shard)
            for i, item in enumerate(block.items):
                no = numbers[np.unique(block.term_of[block.first[i]:block.first[i + 1]])]
                if not len(no) or (no < 0).any():
                    continue
                lists = sorted((shard.positions[shard.at[t]:shard.at[t + 1]] for t in no), key=len)
                docs = shard.doc_of(lists[0])
                for more in lists[1:]:
                    docs = np.intersect1d(docs, shard.doc_of(more))
                for d in np.unique(docs):
                    lo, hi = shard.first[d], shard.first[d + 1]
                    near = [x[np.searchsorted(x, lo):np.searchsorted(x, hi)] for x in lists]
                    best = _shortest_run(near, span)
                    if best:
                        rows.append((shard.doc_ids[d], item, int(best[0] - lo), int(best[1])))
            return rows

        part = _over_shards(index, block, each, MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def _shortest_run(lists: list[np.ndarray], span: int) -> tuple[int, int] | None:
    where = np.concatenate(lists)
    which = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(where, kind="stable")
    last, best = {}, None
    for p, k in zip(where[order].tolist(), which[order].tolist(), strict=True):
        last[k] = p
        if len(last) == len(lists):
            start = min(last.values())
            n = p - start + 1
            if n <= span and (best is None or n < best[1]):
                best = (start, n)
    return best


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, share: int = 20,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words inside an occurring window, items hit, and the verdict.

    ``contaminated``: some word is hit and ``share`` times the hit words are at
    least the document's words.
    """
    index = build_index(docs)
    blocks = list(_blocks(bench, "item_id", "text", window, block_bytes)) if _fits(bench, block_bytes) else None
    if blocks is not None:
        def each(shard: Shard, block: Block) -> list[tuple]:
            covered, items = _cover(shard, block)
            n = np.diff(shard.first)
            before = np.concatenate([[0], np.cumsum(covered)])
            hit = before[shard.first[1:]] - before[shard.first[:-1]]
            return [_verdict(shard.doc_ids[d], int(n[d]), int(hit[d]), items.get(d, ()), share) for d in range(len(n))]

        return _over_shards(index, blocks[0], each, RESULT_SCHEMA)
    return _merge_blocks(index, bench, window, share, block_bytes)


def keep_clean(docs: DataFrame, bench: DataFrame, window: int = WINDOW, share: int = 20, text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are.

    Texts are named by their 64-bit hash, so null or repeated ids do not matter.
    """
    named = docs.select(F.xxhash64(F.col(text_col).cast("string")).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bad = stage(contamination(named, bench, window, share, block_bytes).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    if bad.count() <= BROADCAST_KEYS:
        bad = F.broadcast(bad)
    return docs.join(bad, F.xxhash64(F.col(text_col).cast("string")) == F.col("_bad"), "left_anti")


def _fits(bench: DataFrame, block_bytes: int) -> bool:
    return (bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) < block_bytes


def _cover(shard: Shard, block: Block) -> tuple[np.ndarray, dict[int, set]]:
    item, start, length = block.occurrences(shard)
    edge = np.zeros(shard.n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    items: dict[int, set] = {}
    for d, i in {*zip(shard.doc_of(start).tolist(), item.tolist(), strict=True)}:
        items.setdefault(d, set()).add(block.items[i])
    return np.cumsum(edge)[:-1] > 0, items


def _verdict(doc_id, n_words: int, n_hit: int, items, share: int) -> tuple:
    named = sorted(x for x in items if x is not None)
    return (doc_id, n_words, n_hit, len(named), hashlib.sha256(",".join(named).encode()).hexdigest(),
            n_hit > 0 and share * n_hit >= n_words)


def _merge_blocks(index: DataFrame, bench: DataFrame, window: int, share: int, block_bytes: int) -> DataFrame:
    """The same over a benchmark of several blocks: each block's cover of a document is a bitmap; bitmaps are or-ed."""
    schema = "shard string, row int, doc_id bigint, n_words bigint, covered binary, items array<string>"
    part = None
    for block in _blocks(bench, "item_id", "text", window, block_bytes):
        def each(shard: Shard, block: Block, all_rows: bool = part is None) -> list[tuple]:
            covered, items = _cover(shard, block)
            return [(shard.name, d, shard.doc_ids[d], int(hi - lo), np.packbits(covered[lo:hi]).tobytes(), sorted(items.get(d, ()), key=str))
                    for d, (lo, hi) in enumerate(zip(shard.first[:-1], shard.first[1:], strict=True)) if all_rows or d in items]

        one = stage(_over_shards(index, block, each, schema), "block-hits")
        part = one if part is None else part.unionByName(one)

    def merged(frames):
        import pandas as pd

        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                bits = np.zeros(len(r.covered[0]), np.uint8)
                for x in r.covered:
                    bits |= np.frombuffer(x, np.uint8)
                doc = None if pd.isna(r.doc_id) else int(r.doc_id)
                out.append(_verdict(doc, int(r.n_words), int(np.unpackbits(bits).sum()), {i for x in r.items for i in x}, share))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]).astype({"doc_id": "Int64"})

    return part.groupBy("shard", "row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_list("covered").alias("covered"),
                                            F.collect_list("items").alias("items")).drop("shard", "row").mapInPandas(merged, RESULT_SCHEMA)
