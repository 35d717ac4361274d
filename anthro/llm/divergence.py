"""Source divergence audit: how far the word use of a language's sources lies apart.

For each language a count vectoriser with a least document frequency and no limit
of vocabulary: every document is a sparse vector of term counts; the vectors of a
(lang, source) group are added up; sums are smoothed to whole billionths,

    p = 1 + floor(1e9 * (count + 1) / (N + V))      N: the group's kept terms, V: terms kept,

and two distributions p, q lie apart by the sum of f = floor((p - q)^2 / q).

``term_vectors`` adds the document vectors up inside every task and shuffles the
sums once, by (lang, term); a stored row is one kept term with its counts by
source.  The vocabulary therefore is a table, never a list on the driver.

Pairs are evaluated sparsely.  With zero counts p depends on the source alone
(p0), so the sum over all V terms is

    V f(p0, q0) + sum over s's terms of f(p, q0) - f(p0, q0)
                + sum over t's terms of f(p0, q) - f(p0, q0)
                + sum over terms of both of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

where the second and third need only how many terms have each count, and the last
only the sources that a stored row names; a task adds these up for its rows and
sends one sum for each pair of sources.  All numbers are 64-bit integers, sums
are exact.

Defined results: null text, lang and source count as empty strings; a document
without terms makes its group occur; repeated rows are documents of their own;
extra columns are ignored; an empty table gives no rows; ties rank by item in
UTF-8 order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, give_back, row_ranges, stage
from anthro.llm.textnum import Words, byte_table, distinct_words

LEAST_DOCS = 3
MOST_TERMS = 200
BILLION = 1_000_000_000
BROADCAST_GROUPS = 200_000
HELD_ROWS = 400_000       # sums that a task holds before it sends them
PAIRS = 1 << 21           # pairs of sources evaluated at once

TERM_TABLE = byte_table({b for b in range(128) if not chr(b).isalpha()})
_COUNTS = "lang string, source string, term string, n bigint, df bigint"
_PAIRS = "lang string, source string, item string, value bigint"


# ---------------------------------------------------------------- vectors

def group_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """(lang, source, term, n, df) over the given documents."""
    words = Words(text, TERM_TABLE)
    group = pa.table({"lang": lang, "source": source})
    names = group.group_by(["lang", "source"], use_threads=False).aggregate([])
    number = {pair: i for i, pair in enumerate(zip(names["lang"].to_pylist(), names["source"].to_pylist(), strict=True))}
    of_row = np.array([number[p] for p in zip(lang.to_pylist(), source.to_pylist(), strict=True)], np.int64)
    place = np.argsort(np.argsort(of_row, kind="stable"), kind="stable")  # documents of one group side by side
    doc = words.doc
    order = np.lexsort((place[doc], words.hash))
    h, d, g = words.hash[order], doc[order], of_row[doc][order]
    new_term = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    new_group = new_term | np.concatenate([[True], g[1:] != g[:-1]]) if len(h) else new_term
    new_doc = new_group | np.concatenate([[True], d[1:] != d[:-1]]) if len(h) else new_term
    at = np.flatnonzero(new_group)
    n = np.diff(np.concatenate([at, [len(h)]]))
    df = np.add.reduceat(new_doc.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    which = names.take(pa.array(g[at]))
    return pa.table({"lang": which["lang"], "source": which["source"], "term": distinct_words(words, order[at]), "n": pa.array(n), "df": pa.array(df)})


def _added_up(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("df", "sum")])
    return out.rename_columns({"n_sum": "n", "df_sum": "df"}).select(["lang", "source", "term", "n", "df"])


def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def term_vectors(docs: DataFrame, least_docs: int = LEAST_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One stored row per kept term: lang, term, total, counts (array of source and n)."""
    arrow = arrow_schema(_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = last = 0
        for b in row_ranges(batches, "text"):
            held.append(group_counts(column(b, "lang"), column(b, "source"), column(b, "text")))
            rows += held[-1].num_rows
            if rows > max(HELD_ROWS, 2 * last):
                held = [_added_up(held)]
                rows = last = held[0].num_rows
                if rows > HELD_ROWS:
                    yield from held[0].cast(arrow).to_batches(max_chunksize=20_000)
                    held, rows, last = [], 0, 0
        if held:
            yield from _added_up(held).cast(arrow).to_batches(max_chunksize=20_000)
        give_back()

    counts = _texts(docs, text_col, lang_col, source_col).mapInArrow(run, _COUNTS).repartition("lang", "term")
    sums = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = sums.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return stage(terms.where(F.col("df") >= least_docs).drop("df"), "term-vectors")


# ---------------------------------------------------------------- divergence

def _share_sql(count: str, all_: str) -> str:
    """1 + floor(1e9 * (count + 1) / all_), by two divisions, so that nothing passes 2^63 while ``all_`` is below 9e13."""
    rest = f"(({count} + 1L) % {all_})"
    return (f"(1L + {BILLION}L * (({count} + 1L) div {all_}) + 10000L * ({rest} * 100000L div {all_}) "
            f"+ (({rest} * 100000L) % {all_}) * 10000L div {all_})")


def _apart_sql(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _share(count: np.ndarray, all_: np.ndarray) -> np.ndarray:
    whole, rest = np.divmod(count + 1, all_)
    high, rest = np.divmod(rest * 100_000, all_)
    return 1 + BILLION * whole + 10_000 * high + rest * 10_000 // all_


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class PairSums:
    """Sums by pair of groups, of the terms that both have."""

    def __init__(self):
        self.codes: dict[tuple, int] = {}
        self.names: list[tuple] = []
        self.key, self.value = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def number(self, lang: str, source: str) -> int:
        at = self.codes.setdefault((lang, source), len(self.names))
        if at == len(self.names):
            self.names.append((lang, source))
        return at

    def add(self, code: np.ndarray, p: np.ndarray, p0: np.ndarray, sizes: np.ndarray) -> None:
        """Rows of whole terms, ``sizes`` rows each."""
        many = np.repeat(sizes, sizes)                       # partners of each row, itself included
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)   # first row of its term
        ends = np.cumsum(many)
        lo = 0
        while lo < len(code):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo] - many[lo]) + PAIRS, "right")))
            m = many[lo:hi]
            x = np.repeat(np.arange(lo, hi), m)
            y = np.arange(len(x)) - np.repeat(np.cumsum(m) - m, m) + first[x]
            keep = x != y
            x, y = x[keep], y[keep]
            value = _apart(p[x], p[y]) - _apart(p[x], p0[y]) - _apart(p0[x], p[y]) + _apart(p0[x], p0[y])
            self._merge((code[x] << 32) | code[y], value)
            lo = hi

    def _merge(self, key: np.ndarray, value: np.ndarray) -> None:
        key, value = np.concatenate([self.key, key]), np.concatenate([self.value, value])
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.key, self.value = key[at], np.add.reduceat(value[order], at)

    def batches(self, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The sums so far, which are then forgotten."""
        key, value = self.key, self.value
        self.key, self.value = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo in range(0, len(key), 20_000):
            x, y = [(key[lo:lo + 20_000] >> 32).tolist(), (key[lo:lo + 20_000] & 0xFFFFFFFF).tolist()]
            cols = [self.names[i][0] for i in x], [self.names[i][1] for i in x], [self.names[i][1] for i in y]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols], pa.array(value[lo:lo + 20_000])], schema=arrow)


def _shared_terms(placed: DataFrame) -> DataFrame:
    """(lang, source, item, value): each task's sums over the terms that both sources have.

    ``placed``: one row per source of a term (lang, source, n, all, place, many), a term's rows side by side.
    """
    arrow = arrow_schema(_PAIRS)

    def evaluate(sums: PairSums, rows: pa.Table) -> None:
        code = np.array([sums.number(a, b) for a, b in zip(rows["lang"].to_pylist(), rows["source"].to_pylist(), strict=True)], np.int64)
        n, total, place, many = (np.asarray(rows[c]).astype(np.int64) for c in ("n", "all", "place", "many"))
        sums.add(code, _share(n, total), _share(np.zeros_like(n), total), many[place == 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PairSums()
        kept: list[pa.RecordBatch] = []
        have = 0
        for b in batches:
            kept.append(b)
            have += b.num_rows
            if have < HELD_ROWS // 4:
                continue
            rows = pa.Table.from_batches(kept)
            ends = np.flatnonzero(np.asarray(rows["place"]) == np.asarray(rows["many"]) - 1)
            cut = int(ends[-1]) + 1 if len(ends) else 0  # after the last whole term
            if cut:
                evaluate(sums, rows.slice(0, cut))
                kept, have = rows.slice(cut).to_batches(), have - cut
            if len(sums.key) > HELD_ROWS:
                yield from sums.batches(arrow)
        if have:
            evaluate(sums, pa.Table.from_batches(kept))
        yield from sums.batches(arrow)
        give_back()

    return placed.select("lang", "source", "n", "all", "place", "many").mapInArrow(run, _PAIRS)


def _apart_col(p: str, q: str) -> Column:
    return F.expr(_apart_sql(p, q))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, and the ``most_terms`` terms that stand out."""
    vectors = term_vectors(docs, least_docs, text_col, lang_col, source_col)
    flat = vectors.select("lang", "term", "total", F.size("counts").alias("many"), F.posexplode("counts").alias("place", "_c")) \
        .select("lang", "term", "total", "many", "place", "_c.source", "_c.n")
    # how many terms of a group have each count: the group's size, and all that is needed of terms one source alone has
    levels = stage(flat.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")), "count-levels")
    langs = vectors.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    sizes = levels.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("terms")).alias("size"))
    occurring = _texts(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
    groups = stage(occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
                   .select("lang", "source", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce(F.col("size") + F.col("kept"), F.col("kept"), F.lit(0)).alias("all"),
                           (F.col("lang_size") + F.col("kept")).alias("lang_all")), "groups")
    few = groups.count() <= broadcast_groups
    small = F.broadcast if few else (lambda df: df)

    placed = flat.join(small(groups), ["lang", "source"])
    if not few:
        placed = placed.repartition("lang", "term").sortWithinPartitions("lang", "term", "place")
    both = _shared_terms(placed)

    zero = groups.where("kept > 0").withColumn("p0", F.expr(_share_sql("0L", "all"))).select("lang", "source", "kept", "all", "p0")
    other = zero.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("all").alias("q_all"))
    every = zero.join(small(other), "lang").where("source != item")
    none = every.select("lang", "source", "item", (F.col("kept") * _apart_col("p0", "q0")).alias("value"))
    level = levels.join(small(zero), ["lang", "source"]).withColumn("p", F.expr(_share_sql("n", "all")))
    alone = level.join(small(other), "lang").where("source != item")
    mine = alone.select("lang", "source", "item", (F.col("terms") * (_apart_col("p", "q0") - _apart_col("p0", "q0"))).alias("value"))
    theirs = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * (_apart_col("q0", "p") - _apart_col("q0", "p0"))).alias("value"))
    empty = groups.where("kept = 0")
    nothing = empty.select("lang", "source").join(small(empty.select("lang", F.col("source").alias("item"))), "lang").where("source != item") \
        .select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = none.unionByName(mine).unionByName(theirs).unionByName(both).unionByName(nothing).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    terms = flat.join(small(groups), ["lang", "source"]).withColumns({"p": F.expr(_share_sql("n", "all")), "q": F.expr(_share_sql("total", "lang_all"))}) \
        .where("p > q").select("lang", "source", F.col("term").alias("item"), _apart_col("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= most_terms))
