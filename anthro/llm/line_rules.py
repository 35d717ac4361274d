"""Quality rules: text measures, and removal of lines that many documents of a host share.

A line is normalised to its words in lower case (A-Z) with one space between
them, and hashed.  For every host the distinct documents (distinct texts) that
hold a line are counted; a line stands above the limits when more than
``max_docs`` documents, and more than ``max_share`` ten-thousandths of the
host's documents, hold it.  Such lines go, and a document that keeps less than
``least_share`` percent of its words, or fewer than ``least_words``, is depleted.

DataFrame operations only.  A text is read as arrays (words, window hashes,
lines), so its own measures need no shuffle.  Of the lines only hashes are
shuffled, and those of equal texts merge before the shuffle.  Lines held by very
many documents are few (at most lines / n have more than n), so the most common
ones are broadcast and the others joined by a shuffle, where no line has more
than a bounded number of rows.

Defined results: null or empty text has no words, fails the base rules and is
not kept; null hosts are one host; null ids are kept; rows of one id, host and
text each give the same row; extra columns are kept by ``clean`` and ignored by
``verdicts``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import free_name, stage

MAX_DOCS = 10             # documents of a host that may share a line,
MAX_SHARE = 5             # and ten-thousandths of the host's documents
LEAST_SHARE = 50          # percent of its words that a document must keep
LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED = 20        # percent of the words that may lie in repeated windows
BROADCAST_LINES = 1_000_000

_WORD = r"[^\x20\x09-\x0D]"
_SPACE = r"[\x20\x09-\x0D]+"
_KEY = ("_id", "_host", "_text")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def window_hashes(ws: Column, size: int = REPEAT_WINDOW) -> Column:
    """Hashes of all runs of ``size`` words."""
    def runs(h: Column) -> Column:
        starts = F.when(F.size(h) >= size, F.sequence(F.lit(0), F.size(h) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    return _once(F.transform(ws, lambda w: F.xxhash64(w)), runs)


def repeated_words(runs: Column, size: int = REPEAT_WINDOW) -> Column:
    """Words inside runs whose hash occurs twice or more: positions of such runs, then each one's words up to the next."""
    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
                           lambda a, p: F.struct((a["n"] + F.least(F.lit(size), p - a["last"])).alias("n"), p.alias("last")),
                           lambda a: a["n"])

    def doubles(order: Column) -> Column:
        same = F.filter(order, lambda x, i: F.coalesce(x["h"] == F.get(order, i + 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.when(i > 0, F.get(order, i - 1)["h"]), F.lit(False)))
        return covered(F.array_sort(F.transform(same, lambda x: x["i"])))

    placed = F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0)).otherwise(_once(placed, doubles))


def lines(text: Column) -> Column:
    """Lines with a word, in order."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD))


def normalised(line: Column) -> Column:
    """Words in lower case (A-Z) with one space between them."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.trim(F.translate(F.regexp_replace(line, _SPACE, " "), letters, letters.lower()))


def _keyed(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(host_col).cast("string")).alias("_host"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("_text", F.xxhash64("text"))


def measures(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Key (_id, _host, _text) and the base measures of every row; no shuffle."""
    text = F.col("text")
    out = _keyed(docs, id_col, host_col, text_col)
    out = out.select(*_KEY, F.length(F.regexp_replace(text, _SPACE, "")).cast("long").alias("word_chars"),
                     F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines(text).alias("_lines"), words(text).alias("_words"))
    out = out.select(*_KEY, "word_chars", "n_symbols", F.size("_words").cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), window_hashes(F.col("_words")).alias("_runs"))
    return out.withColumn("n_repeat_words", repeated_words(F.col("_runs")).cast("long")).drop("_runs")


def line_table(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(_id, _host, _text, place, line, n): hash and number of words of every line with a word."""
    rows = _keyed(docs, id_col, host_col, text_col).select(*_KEY, F.posexplode(F.split("text", "\n")).alias("place", "_line"))
    return rows.where(F.col("_line").rlike(_WORD)).select(*_KEY, "place", normalised(F.col("_line")).alias("_line")) \
        .select(*_KEY, "place", F.xxhash64("_line").alias("line"), (F.length("_line") - F.length(F.replace("_line", F.lit(" "), F.lit(""))) + 1).alias("n"))


def common_lines(rows: DataFrame, max_docs: int = MAX_DOCS, max_share: int = MAX_SHARE) -> DataFrame:
    """(_host, line, docs) of the lines above the limits, stored."""
    held = rows.select("_host", "line", "_text").distinct()
    counts = held.groupBy("_host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs)
    hosts = rows.select("_host", "_text").distinct().groupBy("_host").agg(F.count("*").alias("all"))
    return stage(counts.join(hosts, "_host").where(f"10000 * docs > {int(max_share)} * all").drop("all"), "common-lines")


def removed(rows: DataFrame, common: DataFrame, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """The rows of ``line_table`` whose line is above the limits.

    ``bound``: the least number of documents such that at most ``broadcast_lines`` lines
    are held by more; those lines are broadcast, the others have at most ``bound``
    documents each and go through a shuffle.
    """
    total = common.agg(F.sum("docs")).first()[0] or 0
    bound = total // broadcast_lines
    keys = ["_host", "line"]
    found = rows.join(F.broadcast(common.where(F.col("docs") > bound).select(*keys)), keys, "left_semi")
    if bound:
        rest = common.where(F.col("docs") <= bound).select(*keys)
        found = found.unionByName(rows.join(rest.hint("merge"), keys, "left_semi"))
    return found


def _judged(docs: DataFrame, id_col: str, host_col: str, text_col: str, max_docs: int, max_share: int, least_share: int, least_words: int,
            broadcast_lines: int) -> DataFrame:
    """Key, measures, removed lines (their number, words and places) and verdict of every row."""
    rows = line_table(docs, id_col, host_col, text_col)
    gone = removed(rows, common_lines(rows, max_docs, max_share), broadcast_lines)
    # repeated rows name the same lines: each place counts once
    each = gone.groupBy(*_KEY, "place").agg(F.max("n").alias("n"))
    lost = each.groupBy(*_KEY).agg(F.count("*").alias("n_removed_lines"), F.sum("n").alias("n_removed_words"), F.collect_list("place").alias("places"))
    lost = lost.withColumnsRenamed({k: f"_lost{k}" for k in _KEY})
    out = measures(docs, id_col, host_col, text_col)
    out = out.join(lost, F.col("_id").eqNullSafe(F.col("_lost_id")) & (F.col("_host") == F.col("_lost_host")) & (F.col("_text") == F.col("_lost_text")), "left")
    out = out.withColumns({x: F.coalesce(x, F.lit(0)).cast("long") for x in ("n_removed_lines", "n_removed_words")})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (100 * left < least_share * F.col("n_words")) | (left < least_words)
    return out.withColumns({"base_failed": failed, "kept": ~failed & ~depleted})


def verdicts(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_docs: int = MAX_DOCS, max_share: int = MAX_SHARE,
             least_share: int = LEAST_SHARE, least_words: int = LEAST_WORDS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """One row per row of ``docs``: id, measures, removed lines and words, base_failed, kept."""
    out = _judged(docs, id_col, host_col, text_col, max_docs, max_share, least_share, least_words, broadcast_lines)
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines",
                      "n_removed_words", "base_failed", "kept")


def clean(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_docs: int = MAX_DOCS, max_share: int = MAX_SHARE,
          least_share: int = LEAST_SHARE, least_words: int = LEAST_WORDS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """The kept rows of ``docs``, all columns, their texts without the lines above the limits (other lines as they are)."""
    out = _judged(docs, id_col, host_col, text_col, max_docs, max_share, least_share, least_words, broadcast_lines)
    names = {x: free_name(docs, f"_kept{x}") for x in (*_KEY, "places")}
    good = out.where("kept").select(*names).dropDuplicates(list(_KEY)).withColumnsRenamed(names)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.join(good, F.col(id_col).eqNullSafe(F.col(names["_id"])) & (F.xxhash64(F.col(host_col).cast("string")) == F.col(names["_host"]))
                     & (F.xxhash64(text) == F.col(names["_text"])))
    parts = F.split(F.col(text_col).cast("string"), "\n")
    rest = _once(parts, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(names["places"])), lambda i: F.get(x, i)), "\n"))
    return rows.withColumn(text_col, F.when(F.col(names["places"]).isNull(), F.col(text_col)).otherwise(rest)).select(*docs.columns)
