"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Documents are sets of word shingles; two link when their Jaccard similarity is
at least ``percent`` / 100.  The join runs over distinct sets (equal sets are
one class), in these steps:

1.  ``shingle_sets``: size and 64-bit key of every document's set.  The same
    pass counts shingles and words in a sketch of bounded size.
2.  ``prefixes``: shingles are ordered rare first: those that the sketch
    finds frequent go last, the others by how rare their words are, then by hash.
    Any order that depends on the shingle alone keeps the join exact, the sketch
    only makes it cheap.  A set of n needs an overlap of at least
    t = ceil(percent * n / 100) with any partner, so it must share l of its
    first n - t + l shingles with it, for every l up to ``most_shared``.
3.  ``posting_lists``: the lists of these shingles, and their exact lengths.  Each
    document picks the l with the least estimated cost: list entries read plus
    candidates to verify.
4.  Candidates.  First each list links its members to one hub, the set in which
    the shingle comes first (of near copies, that is the one with the fewest
    shingles of its own): a number of pairs linear in the lists.  Verified links
    are joined to components.  Then pairs that share a list and lie in different
    components are tried, where size and position allow the overlap.  Near copies
    share many lists: an entry names the listed shingle just before it, and a
    pair is taken up only where the two differ in it, which holds at its first
    common shingle.  At least min(l, l') prefix shingles must be shared.
    Links inside a component cannot change it, so a large group of copies
    never becomes all its pairs.
5.  Verification on the exact sets (64-bit shingle hashes).

Groups are numbered by set key; a key or group with very many rows is joined by
broadcast, of which there are few by count, the rest by a shuffle.

Defined results: null or empty text, or no words, gives an empty set, linked
with nothing; null ids take part, and a component's id is its least non-null
id; repeated rows are copies; extra columns are ignored.  Sets are told apart
by 64-bit keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, free_name, row_ranges, stage
from anthro.llm.components import connected_components
from anthro.llm.textnum import SPACE_TABLE, Words, distinct_per_row, mix, ngram_hashes, run_sums, slices

SHINGLE = 3
PERCENT = 90
MOST_SHARED = 4           # largest l
VERIFY_COST = 20          # list entries that one verification is worth
CHANCE = 0.5              # partners that a rare shingle has by chance,
SAME = 0.02               # and how often such a partner shares one more
SKETCH_BITS = 21          # counters in each of the sketch's three rows: 2 ** 21 at least,
MOST_BITS = 23            # and 2 ** 23 (48 MB in all) at most, however large the input
LOG_UNITS = 2048
TASK_COUNT = 65_535       # at which a task's counter stops (sums of tasks do not)
SEGMENT = 1 << 14         # counters sent in one row
BROADCAST_KEYS = 1_000_000
SENT_TOKENS = 2_000_000   # of shared shingles sent to the workers (16 MB), else joined
SEEN_KEYS = 100_000

_SETS = "doc_id bigint, key bigint, n int, segment int, counters binary"
_POSTINGS = "token bigint, key bigint, n int, pos int"


def _sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, int]:
    h, r = ngram_hashes(Words(texts, SPACE_TABLE), shingle, short=True)
    return h, r, len(texts)


def _distinct(h: np.ndarray, rows: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """Numbers of the distinct (hash, row), by row, then ``order`` (functions of the hash), then hash."""
    at = np.lexsort((h, *order[::-1], rows))
    keep = np.ones(len(at), bool)
    keep[1:] = (h[at][1:] != h[at][:-1]) | (rows[at][1:] != rows[at][:-1])
    return at[keep]


def set_keys(h: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Key and size of each row's set, from distinct shingles ordered by row."""
    n = np.bincount(rows, minlength=n_rows)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
    edges = np.concatenate([[0], np.cumsum(n)])
    return mix((sums[edges[1:]] - sums[edges[:-1]]) + n.astype(np.uint64)).view(np.int64), n


def packed(counters: np.ndarray) -> bytes:
    """Counters with all their low bytes first, compressed: a task's are mostly a few bits each."""
    return pa.compress(counters.view(np.uint8).reshape(-1, 2).T.tobytes(), "zstd", asbytes=True)


def unpacked(raw: pa.Buffer, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 2 * size, "zstd"), np.uint8).reshape(2, size)
    return planes.T.copy().view(np.uint16).ravel()


class Sketch:
    """Counts of shingles (a count-min sketch of two rows) and of words (one row), as logarithms.

    A counter c is kept as ``LOG_UNITS * log2(1 + c)``, so it never overflows.
    ``extra``: a shingle's count beyond what collisions explain.  ``weight``:
    how common a word is, in sixteenths of a doubling; whole, so that sums over shingles
    are the same wherever these stand.
    """

    def __init__(self, logs: np.ndarray):
        self.logs = logs
        mean = min(float(np.mean(self._counts(row))) for row in logs[:2])
        self.noise = mean + 6 * np.sqrt(mean) + 1

    @staticmethod
    def log_counts(counts: np.ndarray) -> np.ndarray:
        return np.minimum(np.round(LOG_UNITS * np.log2(1.0 + counts)), 65_535).astype(np.uint16)

    @staticmethod
    def _counts(logs: np.ndarray) -> np.ndarray:
        return np.round(np.exp2(logs.astype(np.float32) / LOG_UNITS) - 1)

    @staticmethod
    def slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        return (h >> np.uint64(64 - bits)).astype(np.int64), ((h >> np.uint64(8)) & np.uint64((1 << bits) - 1)).astype(np.int64)

    def extra(self, h: np.ndarray) -> np.ndarray:
        a, b = self.slots(h, int(self.logs.shape[1]).bit_length() - 1)
        count = self._counts(np.minimum(self.logs[0, a], self.logs[1, b])).astype(float)
        return np.where(count > self.noise, count - self.noise, 0.0)

    def weight(self, word: np.ndarray) -> np.ndarray:
        bits = int(self.logs.shape[1]).bit_length() - 1
        return (self.logs[2, self.slots(word, bits)[0]] // (LOG_UNITS // 16)).astype(np.int64)


def bits_for(docs: DataFrame, text_col: str) -> int:
    """Counters (as a power of two) that keep about 64 shingles to each, between the two bounds."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return min(MOST_BITS, max(SKETCH_BITS, (size // 384).bit_length()))


def shingle_sets(docs: DataFrame, shingle: int, id_col: str, text_col: str, sketch_bits: int | None = None) -> tuple[DataFrame, Sketch]:
    """(doc_id, key, n) of every document, stored; and the corpus sketch."""
    arrow = arrow_schema(_SETS)
    sketch_bits = sketch_bits or bits_for(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((3, 1 << sketch_bits), np.uint16)
        for b in row_ranges(batches, "text"):
            words, n_rows = Words(column(b, "text"), SPACE_TABLE), b.num_rows
            h, r = ngram_hashes(words, shingle, short=True)
            for row, slot in enumerate([*Sketch.slots(h, sketch_bits), Sketch.slots(words.hash, sketch_bits)[0]]):
                at, many = np.unique(slot, return_counts=True)
                counters[row, at] = np.minimum(counters[row, at] + many, TASK_COUNT)
            key, n = set_keys(*distinct_per_row(h, r), n_rows)
            none = pa.nulls(n_rows, pa.int32()), pa.nulls(n_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(key), pa.array(n.astype(np.int32)), *none], schema=arrow)
        flat = counters.reshape(-1, SEGMENT)
        full = np.flatnonzero(flat.any(axis=1))
        for lo in range(0, len(full), 32):
            part = full[lo:lo + 32]
            none = [pa.nulls(len(part), t) for t in (pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(part.astype(np.int32)), pa.array([packed(flat[i]) for i in part], pa.binary())],
                                             schema=arrow)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(column(b, "segment").to_pylist(), column(b, "counters"), strict=True):
                x = unpacked(raw.as_buffer(), SEGMENT)
                sums[i] = sums[i] + x if i in sums else x.astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([Sketch.log_counts(x).tobytes() for x in sums.values()], pa.binary())],
                                         schema=arrow_schema("segment int, counters binary"))

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    both = stage(src.mapInArrow(run, _SETS), "sets")
    parts = both.where("segment is not null").select("segment", "counters").repartition("segment").mapInArrow(add_up, "segment int, counters binary")
    sketch = np.zeros(3 << sketch_bits, np.uint16).reshape(-1, SEGMENT)
    for r in parts.collect():  # the sketch has a bounded size: 3 * 2 ** MOST_BITS counters
        sketch[r.segment] = np.frombuffer(r.counters, np.uint16)
    return both.where("segment is null").select("doc_id", "key", "n"), Sketch(sketch.reshape(3, -1))


def prefixes(docs: DataFrame, sketch: Sketch, shingle: int, percent: int, text_col: str, most_shared: int = MOST_SHARED) -> DataFrame:
    """Posting entries (token, key, n, pos) of every set's longest prefix, stored."""
    arrow = arrow_schema(_POSTINGS)
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        seen: set[int] = set()
        for b in row_ranges(batches, "text"):
            words, n_rows = Words(column(b, "text"), SPACE_TABLE), b.num_rows
            h, r = ngram_hashes(words, shingle, short=True)
            extra = counts.extra(h)
            level = np.floor(np.log2(extra + 1)) + (extra > 0)
            common = run_sums(words, counts.weight(words.hash), shingle) // 16
            at = _distinct(h, r, level, common)
            h, r = h[at], r[at]
            keys, sizes = set_keys(h, r, n_rows)
            first = np.concatenate([[0], np.cumsum(sizes)])
            least = -(-percent * sizes // 100)
            take = np.minimum(sizes, sizes - least + np.minimum(most_shared, least))
            for i, k in enumerate(keys.tolist()):
                if k in seen:
                    take[i] = 0  # an equal set of this task has sent its prefix
                elif len(seen) < SEEN_KEYS:
                    seen.add(k)
            rows = np.repeat(np.arange(n_rows), take)
            pos = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                h[first[rows] + pos].view(np.int64), keys[rows], sizes[rows].astype(np.int32), pos.astype(np.int32))],
                schema=arrow)

    return stage(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, _POSTINGS), "prefixes")


def least_overlap(percent: int) -> str:
    """SQL of t, the overlap that a set of n needs at least."""
    return f"(({percent} * n + 99) div 100)"


def choose_need(entries: DataFrame, percent: int, most_shared: int = MOST_SHARED) -> DataFrame:
    """``entries`` (token, key, n, pos, length) with ``need``, the l whose prefix has the least estimated cost.

    ``length``: sets in the entry's list.  Members of a list that is long come again
    in the next lists, so a larger l does not thin them out and only adds entries;
    partners by chance seldom share another shingle.  Cost counts exact lengths of the
    document's own lists, so that other documents do not change it.
    """
    t = least_overlap(percent)
    over = Window.partitionBy("key")
    costs = []
    for need in range(1, most_shared + 1):
        size = f"least(n, n - {t} + {need})"
        read = F.sum(F.expr(f"CASE WHEN pos < {size} THEN length - 1 ELSE 0 END")).over(over)
        cost = F.expr(size) + read + VERIFY_COST * (read + F.lit(CHANCE * SAME ** (need - 1)) * F.expr(size))
        costs.append(F.when(F.expr(f"{need} <= greatest({t}, 1)"), F.struct(cost.cast("double").alias("cost"), F.lit(need).alias("need"))))
    return entries.withColumn("need", F.array_min(F.array(*costs))["need"])


def _with_tokens(postings: DataFrame, tokens: DataFrame, most: int) -> DataFrame:
    """The postings of the distinct ``tokens``; up to ``most`` of these are sent as one sorted array, which takes a tenth of a broadcast table's memory."""
    if tokens.count() > most:
        return postings.join(tokens, "token")
    sent = postings.sparkSession.sparkContext.broadcast(np.sort(np.asarray(tokens.toArrow()["token"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for b in batches:
            token = np.asarray(column(b, "token"))
            at = np.minimum(np.searchsorted(wanted, token), len(wanted) - 1)
            yield b.filter(pa.array(wanted[at] == token)) if len(wanted) else b.slice(0, 0)

    return postings.mapInArrow(run, _POSTINGS)


def posting_lists(postings: DataFrame, percent: int, most_shared: int = MOST_SHARED, sent_tokens: int = SENT_TOKENS) -> DataFrame:
    """Entries (token, key, n, pos, need, before, is_hub) of the lists that hold more than one set; stored.

    ``before``: the token of the set's listed prefix just before the entry's.
    """
    shared = postings.groupBy("token").agg(F.min("key").alias("least"), F.max("key").alias("last")).where("least != last").select("token")
    entries = _with_tokens(postings, stage(shared, "shared"), sent_tokens).dropDuplicates(["token", "key"])
    # in the prefix that the set sends at any need: by position, then the key's low 40 bits
    rank = F.expr(f"CASE WHEN pos <= n - {least_overlap(percent)} THEN pos * 1099511627776L + (key & 1099511627775L) END")
    lists = entries.groupBy("token").agg(F.count("*").alias("length"), F.min(rank).alias("hub"))
    counted = choose_need(entries.join(lists, "token"), percent, most_shared)
    inside = Window.partitionBy("key").orderBy("pos")
    return stage(counted.where(f"pos < n - {least_overlap(percent)} + need").withColumn("before", F.lag("token").over(inside))
                 .select("token", "key", "n", "pos", "need", "before", F.coalesce(rank == F.col("hub"), F.lit(False)).alias("is_hub")), "lists")


def member_sets(docs: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(key, shingles) of every set in a pair (a, b): sorted 64-bit hashes as bytes; stored, one row a key.

    A key has one document here unless ids repeat or are null, so only then are rows shuffled to drop the others.
    """
    out = "key bigint, shingles binary"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in row_ranges(batches, "text"):
            h, r, n_rows = _sets(column(b, "text"), shingle)
            h, r = distinct_per_row(h, r)
            keys, sizes = set_keys(h, r, n_rows)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            new = []
            for i, k in enumerate(keys.tolist()):
                if k not in seen:
                    new.append(i)
                    if len(seen) < SEEN_KEYS:
                        seen.add(k)
            yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array([h[edges[i]:edges[i + 1]].tobytes() for i in new], pa.binary())], schema=arrow)

    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    ids = sets.join(keys, "key").groupBy("key").agg(F.min("doc_id").alias("rep")).select("rep").distinct()
    ids = stage(ids, "members")
    if ids.count() <= BROADCAST_KEYS:
        ids = F.broadcast(ids)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = src.join(ids, F.col("id").eqNullSafe(F.col("rep")), "left_semi").select("text")
    found = stage(chosen.mapInArrow(run, out), "member-sets")
    rows, distinct = found.agg(F.count("*"), F.count_distinct("key")).first()
    return found if rows == distinct else stage(found.dropDuplicates(["key"]), "member-sets")


def _met(x: DataFrame, y: DataFrame, where: str) -> DataFrame:
    """One row per list entry pair: keys a < b, the lesser need, what may be shared from there on, both sizes."""
    return (x.alias("x").join(y.alias("y"), F.col("x.token") == F.col("y.token")).where(where)
            .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"), F.least("x.need", "y.need").alias("need"),
                    F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")).alias("room"), (F.col("x.n") + F.col("y.n")).alias("both"))
            .groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need"), F.max("room").alias("room"), F.max("both").alias("both")))


def _possible(percent: int) -> str:
    """The first shared shingle bounds the overlap by what comes after it."""
    return f"{100 + percent} * room >= {percent} * both"


def hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a hub and another set that share at least the lesser need in the hub's lists."""
    cols = ["token", "key", "n", "pos", "need"]
    met = _met(lists.where("is_hub").select(cols), lists.where("not is_hub").select(cols), f"x.key != y.key and {_allowed(percent)}")
    return met.where(f"shared >= need and {_possible(percent)}").select("a", "b")


def pairs_across(placed: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different ``root`` that share at least the lesser need of them.

    A pair is taken up where the tokens just before differ, so at its first common token
    and after each gap; then its shared tokens are counted in the two prefixes.
    """
    met = _met(placed, placed, f"x.root < y.root and {_allowed(percent)} and not (x.before <=> y.before and x.before is not null)")
    pairs = stage(met.where(_possible(percent)).select("a", "b", "need"), "met")
    several = pairs.where("need > 1")
    tokens = lists.groupBy("key").agg(F.collect_list("token").alias("tokens"))  # of a set's prefix: one row before it is joined
    for side in ("a", "b"):
        several = several.join(tokens.withColumnsRenamed({"key": side, "tokens": f"{side}_tokens"}), side)
    enough = several.where("size(array_intersect(a_tokens, b_tokens)) >= need")
    return pairs.where("need = 1").select("a", "b").unionByName(enough.select("a", "b"))


def verify(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; stored."""
    out = "a bigint, b bigint"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(column(b, "left"), column(b, "right"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([column(b, "a").filter(mask), column(b, "b").filter(mask)], schema=arrow)

    left = members.select(F.col("key").alias("a"), F.col("shingles").alias("left"))
    right = members.select(F.col("key").alias("b"), F.col("shingles").alias("right"))
    return stage(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, out), "verified")


def _allowed(percent: int) -> str:
    """Whether sizes and positions of a shared shingle allow the overlap."""
    return (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and "
            f"{100 + percent} * (least(x.n - x.pos, y.n - y.pos) + least(x.need, y.need) - 1) >= {percent} * (x.n + y.n)")


def links(docs: DataFrame, sets: DataFrame, sketch: Sketch, shingle: int, percent: int, id_col: str, text_col: str,
          most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Similar pairs of distinct sets that join the same components as all of them; and those components."""
    lists = posting_lists(prefixes(docs, sketch, shingle, percent, text_col, most_shared), percent, most_shared)
    # A hub that is not first in all lists it shares is undercounted here; the second step misses nothing.
    tried = stage(hub_pairs(lists, percent), "hub-pairs")
    found = verify(tried, member_sets(docs, sets, tried, shingle, id_col, text_col), percent)
    roots = connected_components(found)
    if roots.count() <= BROADCAST_KEYS:  # then the lists are not shuffled for it
        roots = F.broadcast(roots)
    placed = lists.drop("is_hub").join(roots.withColumnRenamed("vertex", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("token")
    open_lists = stage(placed.join(mixed, "token", "left_semi"), "open-lists")
    across = stage(pairs_across(open_lists, lists, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = verify(across, member_sets(docs, sets, across, shingle, id_col, text_col), percent)
    every = found.unionByName(more)
    return every, connected_components(every)


def join_counted(left: DataFrame, right: DataFrame, key: str, rows: str, most: int = BROADCAST_KEYS) -> DataFrame:
    """Left rows with a partner in ``right`` (one row per ``key``; ``rows``: left rows that have it).

    At most ``most`` keys can have more than the left rows / ``most`` of them; these are
    broadcast, so no key brings more rows than that into one task of the shuffle.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    bound = total // most
    out = left.join(F.broadcast(right.where(F.col(rows) > bound).drop(rows)), key)
    return out.unionByName(left.join(right.where(F.col(rows) <= bound).drop(rows), key)) if bound else out


def groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
           most_shared: int = MOST_SHARED, sketch_bits: int | None = None, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(doc_id, key, n, first) of every document: ``first`` (none, doc_id, key) is the group's row of least id (null ids last), null for empty sets.

    Only sets that have a copy or a link are joined to their group.
    """
    sets, sketch = shingle_sets(docs, shingle, id_col, text_col, sketch_bits)
    _, roots = links(docs, sets, sketch, shingle, percent, id_col, text_col, most_shared)
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    full = sets.where("n > 0")
    keys = full.groupBy("key").agg(F.min(own).alias("first"), F.count("*").alias("copies"))
    placed = roots.select(F.col("vertex").alias("key"), "root").unionByName(roots.select(F.col("root").alias("key"), "root").distinct())
    keys = stage(keys.join(placed, "key", "left").where("copies > 1 or root is not null"), "grouped-keys")
    linked = keys.where("root is not null")
    of_root = stage(linked.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("members")), "group-firsts")
    firsts = join_counted(linked.select("key", "copies", "root"), of_root, "root", "members", broadcast_keys).select("key", "copies", F.col("least").alias("first"))
    firsts = stage(firsts.unionByName(keys.where("root is null").select("key", "copies", "first")), "firsts")
    together = join_counted(full, firsts, "key", "copies", broadcast_keys)
    few = firsts.count() <= broadcast_keys
    alone = full.join(F.broadcast(firsts.select("key")) if few else firsts.select("key"), "key", "left_anti").withColumn("first", own)
    empty = sets.where("n = 0").withColumn("first", F.lit(None).cast(alone.schema["first"].dataType))
    return together.select("doc_id", "key", "n", "first").unionByName(alone.select("doc_id", "key", "n", "first")).unionByName(empty.select("doc_id", "key", "n", "first"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                    most_shared: int = MOST_SHARED, sketch_bits: int | None = None, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id it reaches by links)."""
    grouped = groups(docs, shingle, percent, id_col, text_col, most_shared, sketch_bits, broadcast_keys)
    return grouped.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the least id (null ids last), then set key, then text; rows without words all stay."""
    grouped = stage(groups(docs, shingle, percent, id_col, text_col).where("n > 0"), "groups")
    losers = grouped.where("not (doc_id <=> first.doc_id and key = first.key)").select(F.col("doc_id").alias("lost_id"), F.col("key").alias("lost_key")).distinct()
    losers = stage(losers, "losers")
    small = losers.count() <= BROADCAST_KEYS
    key, lost_id, lost_key = (free_name(docs, x) for x in ("_set_key", "_lost_id", "_lost_key"))
    losers = losers.withColumnsRenamed({"lost_id": lost_id, "lost_key": lost_key})
    if small:
        losers = F.broadcast(losers)

    @F.pandas_udf("long")
    def set_key(texts):
        import pandas as pd

        t = pa.array(texts, pa.string(), from_pandas=True)
        out = [np.zeros(0, np.int64)]
        for lo, hi in slices(t):
            h, r, n_rows = _sets(t.slice(lo, hi - lo), shingle)
            k, n = set_keys(*distinct_per_row(h, r), n_rows)
            out.append(np.where(n > 0, k, 0))
        return pd.Series(np.concatenate(out))

    keyed = docs.withColumn(key, set_key(F.col(text_col).cast("string")))
    kept = keyed.join(losers, F.col(id_col).cast("long").eqNullSafe(F.col(lost_id)) & (F.col(key) == F.col(lost_key)), "left_anti")
    if not grouped.groupBy("doc_id", "key").count().where("count > 1").isEmpty():  # repeated rows: the first by text, then the other columns, stays
        rank = free_name(docs, "_rank")
        order = Window.partitionBy(id_col, key).orderBy(*[F.col(c).cast("string") for c in dict.fromkeys([text_col, *docs.columns])])
        kept = kept.where(F.col(key) == 0).unionByName(kept.where(F.col(key) != 0).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank))
    return kept.drop(key)
