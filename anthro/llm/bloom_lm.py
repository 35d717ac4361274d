"""N-gram language model in a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels, level(c) = 1 +
floor(log_base(c)), and an n-gram of level q is put into the filter q times,
once for each level 1..q.  A lookup probes level 1, 2, ... until a probe
misses; the last level that hit gives the count back, so an error can only
raise it.  The filter has room for every counted level and grows with the
n-grams.  Up to ``sent_bytes`` it goes to the workers whole; a larger one stays
a stored table of segments, and the distinct n-grams of the texts are joined
with it.  Both ways probe the same bits.  Scoring keeps the levels of a text's
words and pairs, a byte each.

Scoring works over the V known tokens and one unknown token, the event space of
the base score.  The unknown token gets the Good-Turing share r = n1 / N (n1:
words seen once); P(w) = (1 - r) * c(w) / N for the others, with filter counts.
After a known token u, P(w | u) = a * min(1, c(u w) / c(u)) + (1 - a) * P(w).
The weight a is fitted by expectation maximisation with leave-one-out counts over
all training texts: a token enters by three levels, so Spark counts the
combinations of levels once, and every round is a sum over these.  Text ends are a token; a text's first token has no u.

``base_score`` needs exact counts of all words.  The commonest words' counts
(at most ``head_words``) go to the workers as a sorted array; other words of a
text are joined with the stored table of counts.

Tokens: texts with A-Z lower-cased, split at blanks; then one end.  Words are
told apart by 64-bit hashes.

Defined results: null or empty text is one token, the end; rows with null id are
neither learned from nor held out; repeated rows count each; with nothing to
learn from every score is log10(1) = 0 a token; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, row_ranges, stage
from anthro.llm.textnum import SPACE_TABLE, Words, distinct_per_row, mix, slices

BASE = 1.5                   # of the count levels
PROBES = 3                   # bits for each level
SEGMENT_BITS = 1 << 16       # of the filter; an n-gram's bits lie in one segment
BITS_PER_LEVEL = 10          # a quarter of the bits get set
SENT_BYTES = 96 << 20        # of a filter that workers hold; a larger one is joined
TASK_SEGMENTS = 512          # filled by one task
BLOCK_SEGMENTS = 64          # of a stored filter, sent to be filled and probed together
SENT_GRAMS = 1 << 20         # counted n-grams grouped by block before they are sent
HEAD_WORDS = 500_000
END = np.uint64(0x8F1BBCDCBFA53E0B)   # stands for the end token among word hashes
CHUNK = 1 << 21              # tokens counted together before they are sent
LEVELS = 1 << 18             # tokens scored together
LAST = 255                   # stands for the end token among word levels

_COUNTS = "kind int, gram bigint, n bigint"


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the tokens of each text: its words, then the end."""
    w = Words(texts, SPACE_TABLE)
    n = w.count + 1
    rows = np.repeat(np.arange(len(n)), n)
    out = np.empty(len(rows), np.uint64)
    last = np.cumsum(n) - 1
    inner = np.ones(len(rows), bool)
    inner[last] = False
    out[inner] = w.hash
    out[last] = END
    return out, rows


def pairs_of(tokens: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before it, and a mask of the tokens that have one."""
    has = np.zeros(len(tokens), bool)
    has[1:] = rows[1:] == rows[:-1]
    pair = np.zeros(len(tokens), np.uint64)
    pair[1:] = _pair(tokens[:-1], tokens[1:])
    return pair, has


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram = np.concatenate([g for g, _ in parts])
    many = np.concatenate([n for _, n in parts])
    out, inverse = np.unique(gram, return_inverse=True)
    return out, np.bincount(inverse, many, len(out)).astype(np.int64)


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(kind, gram, n): counts of words (kind 1; without the end) and pairs (kind 2) over all rows of ``text``; stored."""
    arrow = arrow_schema(_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {1: [], 2: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, parts in held.items():
                if parts:
                    gram, n = _merge(parts)
                    for lo in range(0, len(gram), 100_000):
                        g = gram[lo:lo + 100_000].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), kind, np.int32)), pa.array(g), pa.array(n[lo:lo + 100_000])], schema=arrow)
                parts.clear()

        for b in row_ranges(batches, "text"):
            tokens, rows = token_stream(column(b, "text"))
            pair, has = pairs_of(tokens, rows)
            for kind, gram in ((1, tokens[tokens != END]), (2, pair[has])):
                held[kind].append(np.unique(gram, return_counts=True))
            size += len(tokens)
            if size >= CHUNK:
                yield from flush()
                size = 0
        yield from flush()

    return stage(texts.select("text").mapInArrow(run, _COUNTS).groupBy("kind", "gram").agg(F.sum("n").alias("n")), "ngram-counts")


@dataclass
class Filter:
    """Log-frequency Bloom filter over 64-bit n-gram hashes."""

    bits: np.ndarray          # uint8
    segments: int
    first: int = 0            # segment that ``bits`` begins with

    @staticmethod
    def segment(gram: np.ndarray, segments: int) -> np.ndarray:
        return ((gram >> np.uint64(20)) % np.uint64(segments)).astype(np.int64)

    @staticmethod
    def offsets(gram: np.ndarray, level: int) -> list[np.ndarray]:
        """Bit numbers probed for the n-grams at a level, inside their segments."""
        x = mix(gram + np.uint64(level * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        return [((x >> np.uint64(16 * k)) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64) for k in range(PROBES)]

    def has(self, gram: np.ndarray, level: int) -> np.ndarray:
        start = (self.segment(gram, self.segments) - self.first) * SEGMENT_BITS
        found = np.ones(len(gram), bool)
        for offset in self.offsets(gram, level):
            place = start + offset
            found &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found

    def level(self, gram: np.ndarray) -> np.ndarray:
        """Levels given back by repeated probes; 0 if the first misses."""
        level = np.zeros(len(gram), np.int64)
        active = np.arange(len(gram))
        q = 0
        while len(active) and q < 120:
            q += 1
            active = active[self.has(gram[active], q)]
            level[active] = q
        return level

    def count(self, gram: np.ndarray) -> np.ndarray:
        """Counts given back by repeated probes; 0 if the first misses."""
        return count_of(self.level(gram))


def level_of(n: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(n) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """Middle of a level's counts; exact for 0 and 1."""
    low, high = BASE ** (level - 1.0), BASE ** level.astype(float)
    return np.where(level == 0, 0.0, np.where(level == 1, 1.0, (np.ceil(low - 1e-9) + np.maximum(np.ceil(high - 1e-9) - 1, np.ceil(low - 1e-9))) / 2))


def filter_table(counts: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, int]:
    """The filter as a stored table (segment, raw) of the segments with set bits, filled segment by segment, each in one task; and how many segments it has.

    ``max_bytes``, if given, leaves out the rarest pairs by the least count that fits; words that exceed it are an error.
    """
    level = F.floor(F.log(F.col("n").cast("double")) / float(np.log(BASE)) + 1e-9) + 1
    if max_bytes is None:
        kept = counts.agg(F.sum(level)).first()[0] or 0
    else:
        sizes = {r.least: r.levels for r in counts.groupBy(
            F.when(F.col("kind") == 1, F.lit(0)).otherwise(F.least(F.col("n"), F.lit(1000))).alias("least")).agg(F.sum(level).alias("levels")).collect()}
        room = max_bytes * 8 // BITS_PER_LEVEL
        kept, least = sizes.pop(0, 0), 1001
        if kept > room:
            raise ValueError(f"words take {kept} levels, {max_bytes} bytes hold {room}")
        for n in sorted(sizes, reverse=True):
            if kept + sizes[n] > room:
                break
            kept, least = kept + sizes[n], n
        counts = counts.where(f"kind = 1 or n >= {least}")
    segments = -(-max(1, kept) * BITS_PER_LEVEL // SEGMENT_BITS)
    out = "segment int, raw binary"
    arrow = arrow_schema(out)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(segments, -1)                       # of the segments that this task has
        flags = np.zeros((0, SEGMENT_BITS), np.uint8)      # their bits, a byte each
        used = 0
        for b in batches:
            gram, level = (np.frombuffer(b"".join(column(b, c).to_pylist()), t) for c, t in (("grams", np.uint64), ("levels", np.uint8)))
            segment = Filter.segment(gram, segments)
            new = np.unique(segment[slot[segment] < 0])
            slot[new] = used + np.arange(len(new))
            used += len(new)
            if used > len(flags):
                flags = np.concatenate([flags, np.zeros((max(used, 2 * len(flags)) - len(flags), SEGMENT_BITS), np.uint8)])
            for q in range(1, level.max(initial=0) + 1):
                gram, segment, level = gram[level >= q], segment[level >= q], level[level >= q]
                for offset in Filter.offsets(gram, q):
                    flags[slot[segment], offset] = 1
        for s in np.flatnonzero(slot >= 0).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(flags[slot[s]], bitorder="little").tobytes()], pa.binary())],
                                             schema=arrow)

    parts = -(-segments // TASK_SEGMENTS)
    return stage(by_block(counts, segments).repartition(parts, "block").mapInArrow(fill, out), "filter"), segments


def by_block(counts: DataFrame, segments: int) -> DataFrame:
    """(block, grams, levels): of each block of segments a task's n-grams as bytes, so that 9 bytes of an n-gram are shuffled."""
    out = "block bigint, grams binary, levels binary"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, level = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            block = Filter.segment(gram, segments) // BLOCK_SEGMENTS
            order = np.argsort(block, kind="stable")
            block = block[order]
            ends = np.append(np.flatnonzero(block[1:] != block[:-1]) + 1, len(block))
            sent = pa.RecordBatch.from_arrays([pa.array(block[ends - 1]), _bytes_column(gram[order], 8 * ends), _bytes_column(level[order], ends)], schema=arrow)
            for lo in range(0, len(ends), 64):
                yield sent.slice(lo, 64)

        for b in batches:
            if b.num_rows:
                held.append((np.array(column(b, "gram")).view(np.uint64), level_of(np.asarray(column(b, "n"))).astype(np.uint8)))
                size += b.num_rows
            if size >= SENT_GRAMS:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return counts.select("gram", "n").mapInArrow(run, out)


def _segment(segments: int) -> Column:
    """As in Filter.segment."""
    return F.expr(f"cast(shiftrightunsigned(gram, 20) % {segments}L as int)")


def _filter_of(segment: pa.ChunkedArray, raw: pa.ChunkedArray, segments: int, first: int = 0) -> np.ndarray:
    """Bits of ``segments`` segments from number ``first`` on."""
    size = SEGMENT_BITS // 8
    bits = np.zeros((segments, size), np.uint8)
    for s, r in zip(segment.to_pylist(), raw, strict=True):
        bits[s - first] = np.frombuffer(r.as_buffer(), np.uint8)
    return bits.reshape(-1)


def collect_filter(table: DataFrame, segments: int) -> Filter:
    t = table.toArrow()
    return Filter(_filter_of(t["segment"], t["raw"], segments), segments)


def build_filter(counts: DataFrame, max_bytes: int | None = None) -> Filter:
    """The whole filter, on the driver."""
    return collect_filter(*filter_table(counts, max_bytes))


def probed(grams: DataFrame, table: DataFrame, segments: int) -> DataFrame:
    """(gram, level) of the distinct values of ``gram`` that the stored filter has."""
    out = arrow_schema("gram bigint, level int")

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        gram = np.asarray(left["gram"].combine_chunks()).view(np.uint64) if left.num_rows else np.zeros(0, np.uint64)
        level = np.zeros(len(gram), np.int64)
        if len(gram) and right.num_rows:
            first = right["block"][0].as_py() * BLOCK_SEGMENTS
            level = Filter(_filter_of(right["segment"], right["raw"], BLOCK_SEGMENTS, first), segments, first).level(gram)
        hit = level > 0
        return pa.Table.from_arrays([pa.array(gram[hit].view(np.int64)), pa.array(level[hit].astype(np.int32))], schema=out)

    asked = grams.select("gram").distinct().withColumn("block", F.floor(_segment(segments) / BLOCK_SEGMENTS).cast("int"))
    have = table.withColumn("block", F.floor(F.col("segment") / BLOCK_SEGMENTS).cast("int"))
    return asked.groupBy("block").cogroup(have.groupBy("block")).applyInArrow(probe, "gram bigint, level int")


@dataclass
class Model:
    filter: Filter | None     # None: a stored table
    head: np.ndarray          # sorted hashes of the commonest words
    head_n: np.ndarray
    texts: int                # training texts: the end's count
    tokens: int               # N
    types: int                # V
    unknown: float            # share of the unknown token
    weight: float = 0.0       # of pairs

    def parts(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, left_out: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(w), P of the pair, and where there is a known token before, from the levels of a token, of the one before it
        (0: none) and of both; with ``left_out`` occurrences taken away."""
        counts = count_of(np.arange(LAST + 1))
        counts[LAST] = self.texts
        counts = np.maximum(counts - left_out, 0)
        n, u = counts[word], counts[before]
        alone = np.where(n > 0, (1 - self.unknown) * n / self.tokens, self.unknown)
        after = u > 0
        together = np.where(after, np.minimum(1.0, counts[pair] / np.where(after, u, 1.0)), 0.0)
        return np.minimum(alone, 1.0), together, after

    def score(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """log10 probability of every token."""
        if not self.tokens:
            return np.zeros(len(word))
        alone, together, after = self.parts(word, before, pair)
        return np.log10(np.where(after, self.weight * together + (1 - self.weight) * alone, alone))

    def fit_weight(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, many: np.ndarray, rounds: int = 20) -> None:
        """Expectation maximisation over tokens given by their levels, each ``many`` times."""
        alone, together, after = self.parts(word, before, pair, left_out=1)
        alone, together, many = alone[after], together[after], many[after]
        self.weight = 0.3
        for _ in range(rounds if len(alone) else 0):
            mixed = self.weight * together
            self.weight = float(np.clip(np.average(mixed / (mixed + (1 - self.weight) * alone), weights=many), 1e-4, 0.999))


def _sorted_levels(gram: np.ndarray, level: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Lookup of levels; 0 for other n-grams.  Equal n-grams have equal levels."""
    order = np.argsort(gram)
    gram, level = gram[order], level[order]

    def look(asked: np.ndarray) -> np.ndarray:
        if not len(gram):
            return np.zeros(len(asked), np.int64)
        at = np.minimum(np.searchsorted(gram, asked), len(gram) - 1)
        return np.where(gram[at] == asked, level[at], 0)

    return look


def token_levels(tokens: np.ndarray, rows: np.ndarray, look: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Levels of each token (``LAST`` for the end), and with the known token before it (0: none)."""
    distinct, inverse = np.unique(tokens, return_inverse=True)
    level = look(distinct)
    level[distinct == END] = LAST
    word = level[inverse].astype(np.uint8)
    pair, has = pairs_of(tokens, rows)
    at = np.flatnonzero(has)
    at = at[word[at - 1] > 0]
    out = np.zeros(len(tokens), np.uint8)
    out[at] = look(pair[at])
    return word, out


def _bytes_column(value: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of the runs of ``value`` that stop at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(value))])


def _level_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, row, word, before, pair): the stored levels, by ranges of rows."""
    for b in batches:
        for lo, hi in slices(column(b, "words"), LEVELS) if b.num_rows else ():
            part = b.slice(lo, hi - lo)
            word, pair = (np.frombuffer(b"".join(column(part, c).to_pylist()), np.uint8) for c in ("words", "pairs"))
            n = np.asarray(column(part, "n_tokens"))
            before = np.zeros(len(word), np.uint8)
            before[1:] = word[:-1]
            before[np.cumsum(n)[:-1]] = 0
            yield part, np.repeat(np.arange(len(n)), n), word, before, pair


def train(texts: DataFrame, counts: DataFrame, filter: Filter | None, head_words: int = HEAD_WORDS) -> tuple[Model, DataFrame]:
    """The model, but for the weight of pairs, from the ``text`` rows' n-gram counts; and the exact word counts (gram, n)."""
    words = counts.where("kind = 1").select("gram", "n")
    n_texts = texts.count()
    row = words.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("once")).first()
    head = words.orderBy(F.desc("n"), "gram").limit(head_words).toArrow()
    gram, n = np.asarray(head["gram"]).view(np.uint64), np.asarray(head["n"])
    order = np.argsort(gram)
    total = (row.n or 0) + n_texts
    unknown = min(0.5, max(row.once, 0.5) / total) if total else 0.0
    return Model(filter, gram[order], n[order], n_texts, total, row.v + (n_texts > 0), unknown), words


def level_counts(scored: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, before, pair, many): how often each combination of levels occurs in all training texts.

    Levels are few (some 40 at 10^7 occurrences), so their combinations are, at any size."""
    out = "gram bigint, n bigint"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for _, _, word, before, pair in _level_ranges(batches):
            key = word.astype(np.int64) << 16 | before.astype(np.int64) << 8 | pair
            held = _merge([held, np.unique(key[before > 0], return_counts=True)])
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], schema=arrow)

    t = scored.where("learn").select("n_tokens", "words", "pairs").mapInArrow(run, out).groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    key = np.asarray(t["gram"])
    return key >> 16, key >> 8 & 255, key & 255, np.asarray(t["n"])


_SCORED = "doc_id bigint, learn boolean, n_tokens bigint, n_known bigint, log_counts double, words binary, pairs binary, rest array<bigint>, rest_n array<int>"


def _joined_levels(src: DataFrame, counts: DataFrame, table: DataFrame, segments: int, head_words: int) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """``src`` with the levels of its n-grams (``grams``, ``levels``) from the stored filter; those of the commonest n-grams are given apart."""
    top = probed(counts.orderBy(F.desc("n"), "gram").limit(head_words), table, segments).toArrow()
    gram, level = np.asarray(top["gram"]).view(np.uint64), np.asarray(top["level"])
    sent = src.sparkSession.sparkContext.broadcast(np.sort(gram))
    src = stage(src.withColumn("row", F.monotonically_increasing_id()), "numbered")  # stored, so the row numbers stay
    out = "row bigint, gram bigint"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = sent.value
        for b in row_ranges(batches, "text"):
            tokens, rows = token_stream(column(b, "text"))
            pair, has = pairs_of(tokens, rows)
            word = tokens != END
            g, r = distinct_per_row(np.concatenate([tokens[word], pair[has]]), np.concatenate([rows[word], rows[has]]))
            if len(common):
                other = common[np.minimum(np.searchsorted(common, g), len(common) - 1)] != g
                g, r = g[other], r[other]
            row = np.asarray(column(b, "row"))[r]
            for lo in range(0, len(g), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(row[lo:lo + 100_000]), pa.array(g[lo:lo + 100_000].view(np.int64))], schema=arrow)

    grams = src.select("row", "text").mapInArrow(run, out)
    found = grams.join(stage(probed(grams, table, segments), "probed"), "gram")  # one row for each n-gram on the right, so AQE can split hot ones
    found = found.groupBy("row").agg(F.collect_list(F.struct("gram", "level")).alias("x")).select("row", F.col("x.gram").alias("grams"), F.col("x.level").alias("levels"))
    return src.join(found, "row", "left").drop("row"), (gram, level)


def levelled(src: DataFrame, model: Model, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """The stored levels and known counts of each row of (id, learn, text), with numbers for the rows; ``common`` are levels
    of n-grams that hold besides the columns ``grams`` and ``levels``."""
    arrow = arrow_schema(_SCORED)
    sent = src.sparkSession.sparkContext.broadcast((model, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, top = sent.value
        often = _sorted_levels(*top) if m.filter is None else None
        for b in row_ranges(batches, "text"):
            tokens, rows = token_stream(column(b, "text"))
            size = b.num_rows
            if often is None:
                look = m.filter.level
            else:
                own = _sorted_levels(np.asarray(column(b, "grams").flatten()).view(np.uint64), np.asarray(column(b, "levels").flatten()))
                look = lambda g, own=own: np.maximum(own(g), often(g))
            word, pair = token_levels(tokens, rows, look)
            ends = np.cumsum(np.bincount(rows, minlength=size))
            distinct, inverse = np.unique(tokens, return_inverse=True)
            at = np.minimum(np.searchsorted(m.head, distinct), max(len(m.head) - 1, 0))
            in_head = m.head[at] == distinct if len(m.head) else np.zeros(len(distinct), bool)
            n = np.where(in_head, m.head_n[at] if len(m.head) else 0, 0)
            n[distinct == END] = m.texts
            known = (n > 0)[inverse]
            other = np.flatnonzero((~in_head & (distinct != END))[inverse]) if m.types > len(m.head) + 1 else np.zeros(0, np.int64)
            rest = np.array(sorted(zip(rows[other].tolist(), tokens[other].view(np.int64).tolist(), strict=True)), np.int64).reshape(-1, 2)
            new = np.ones(len(rest), bool)
            new[1:] = (rest[1:] != rest[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(rest)))
            edges = np.searchsorted(rest[first, 0], np.arange(size + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                column(b, "id"), column(b, "learn"), pa.array(np.bincount(rows, minlength=size)), pa.array(np.bincount(rows, known, size).astype(np.int64)),
                pa.array(np.bincount(rows, np.log10(n + 1.0)[inverse], size)), _bytes_column(word, ends), _bytes_column(pair, ends),
                pa.ListArray.from_arrays(edges, pa.array(rest[first, 1])), pa.ListArray.from_arrays(edges, pa.array(many.astype(np.int32)))], schema=arrow)

    return stage(src.mapInArrow(run, _SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")  # stored, so the row numbers stay


def score(scored: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """One row per document of ``levelled``: n_tokens, n_known, train_tokens, base_score, score."""
    out = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, log_counts double, score double"
    arrow = arrow_schema(out)
    small = replace(model, filter=None, head=None, head_n=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows, word, before, pair in _level_ranges(batches):
            p = np.bincount(rows, small.score(word, before, pair), b.num_rows)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("row", "doc_id", "n_tokens", "n_known", "log_counts")), pa.array(p)], schema=arrow)

    rest = (scored.where("size(rest) > 0").select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x"))
            .select("row", F.col("x.rest").alias("gram"), F.col("x.rest_n").alias("many")))
    added = (rest.join(words, "gram").groupBy("row").agg(F.sum("many").alias("more_known"), F.sum(F.log10(F.col("n") + 1) * F.col("many")).alias("more_log")))
    out_of = float(np.log10(max(1, model.tokens + model.types + 1)))
    return scored.select("row", "doc_id", "n_tokens", "n_known", "log_counts", "words", "pairs").mapInArrow(run, out).join(added, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(out_of)).alias("base_score"), "score")


def train_and_score(docs: DataFrame, learn: Column, held_out: Column, sent_bytes: int = SENT_BYTES, head_words: int = HEAD_WORDS) -> DataFrame:
    """Learn from the rows where ``learn`` holds and score all; ``held_out`` is a condition on ``doc_id``."""
    text = F.col("text").cast("string").alias("text")
    texts = docs.where(learn).select(text)
    src = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), text)
    counts = ngram_counts(texts)
    table, segments = filter_table(counts)
    sent = segments * SEGMENT_BITS // 8 <= sent_bytes
    model, words = train(texts, counts, collect_filter(table, segments) if sent else None, head_words)
    common = None
    if not sent:
        src, common = _joined_levels(src, counts, table, segments, head_words)
    scored = levelled(src, model, common)
    model.fit_weight(*level_counts(scored))
    return score(scored, model, words).withColumn("held_out", F.coalesce(held_out, F.lit(False))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
