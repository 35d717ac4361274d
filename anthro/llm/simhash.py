"""SimHash fingerprints and search within a Hamming radius, as DataFrame operations only.

Terms are a text's words with the word after each (white space split, lower
case); a term's weight is how often it occurs.  Each term's 128 hash bits vote
with its weight; a fingerprint bit is set where the votes for it have more than
half the weight.  Votes are counted two to a 64-bit sum (32 bits each), so a
text's fingerprint is one pass of 64 sums.

``near_search`` finds all fingerprints within a radius r of some: with r + 1 blocks
of bits, two such fingerprints are equal in one block at least, so one table for
each block, keyed by the fingerprint permuted to have that block first, brings them
together; at the radius of the report, 3, a key has 32 bits.  Equal fingerprints
are one row of the tables.

``with_next`` pairs each document with the next one in descending id order
without a global sort: ids are cut into buckets at quantiles, each bucket gets a
copy of the next bucket's first row, and the rest is local to the bucket.

Defined results: null text is empty; an empty text's fingerprint is all zeros;
null ids come last; rows of one id are ordered by text; extra columns are
ignored; an empty table gives no rows.  Ids are taken to be nearly unique: rows
of one id share a bucket.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anthro.llm.common import stage

BITS = 128
LANES = 32
RADIUS = 3
ASKED = 50                # ids that this divides are searched for
BUCKET_BYTES = 4 << 20
MOST_BUCKETS = 1 << 16
_MASK = 0x0000000100000001


def term_hashes(text: Column) -> Column:
    """64-bit hashes of a text's terms, one for each word."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    # the words are bound once, as the only element of an array: a lambda that names the expression would evaluate it for every word
    return F.get(F.transform(F.array(words), lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))), F.lit(0))


def _lanes(h: Column, tag: str) -> list[Column]:
    return [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_MASK))).alias(f"{tag}{i}") for i in range(LANES)]


def vote_sums(h: Column) -> list[Column]:
    """Aggregates over a column of term hashes: 2 * 32 packed votes and the total weight."""
    return [*_lanes(h, "_u"), *_lanes(F.when(h.isNotNull(), F.xxhash64(h, F.lit(1))), "_v"), F.count(h).alias("_weight")]


def _word(tag: str) -> Column:
    """64 fingerprint bits from 32 packed sums."""
    lanes = F.array(*[F.coalesce(f"{tag}{i}", F.lit(0)) for i in range(LANES)])
    low = F.transform(lanes, lambda v, i: F.when(v.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("_weight"), F.expr("1L")).otherwise(F.expr("0L")))
    high = F.transform(lanes, lambda v, i: F.when(F.shiftrightunsigned(v, 32) * 2 > F.col("_weight"), F.expr("1L")).otherwise(F.expr("0L")))
    bits = F.reverse(F.concat(low, high))  # most significant first
    return F.aggregate(bits, F.expr("0L"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x))


def fingerprint_columns() -> tuple[Column, Column]:
    """The two 64-bit halves, from the columns of :func:`vote_sums`."""
    return _word("_u"), _word("_v")


def as_text(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def likeness(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Share of equal bits of fingerprints (a, b) and (c, d)."""
    return 1 - (F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))) / F.lit(float(BITS))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f1, f2) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                       term_hashes(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_h"))
    votes = rows.select("doc_id", "_row", F.explode_outer("_h").alias("_h")).groupBy("_row").agg(F.max("doc_id").alias("doc_id"), *vote_sums(F.col("_h")))
    f1, f2 = fingerprint_columns()
    return votes.select("doc_id", f1.alias("f1"), f2.alias("f2"))


# ---------------------------------------------------------------- search

def _blocks(f1: Column, f2: Column, radius: int) -> Column:
    """Array of (table, block): the fingerprint cut into ``radius`` + 1 runs of bits, one of which two fingerprints in the radius share."""
    if not 0 <= radius < BITS:
        raise ValueError("radius must be from 0 to 127")
    bits = F.concat(F.lpad(F.conv(F.hex(f1), 16, 2), 64, "0"), F.lpad(F.conv(F.hex(f2), 16, 2), 64, "0"))
    cut = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[F.struct(F.lit(k).alias("table"), F.substring(bits, cut[k] + 1, cut[k + 1] - cut[k]).alias("block")) for k in range(radius + 1)])


def _apart(a1: str, a2: str, b1: str, b2: str) -> Column:
    return F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))


def near_search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q1, q2, f1, f2, distance, copies): for each distinct query fingerprint all distinct ones of ``prints`` at most ``radius`` bits
    apart, and how many rows have them.  Both have columns f1, f2; null ones match nothing."""
    each = prints.select("f1", "f2").where("f1 is not null and f2 is not null").groupBy("f1", "f2").agg(F.count("*").alias("copies"))
    asked = queries.select(F.col("f1").alias("q1"), F.col("f2").alias("q2")).where("q1 is not null and q2 is not null").distinct()
    tables = each.withColumn("_t", F.explode(_blocks(F.col("f1"), F.col("f2"), radius))).select("f1", "f2", "copies", "_t.table", "_t.block")
    keys = asked.withColumn("_t", F.explode(_blocks(F.col("q1"), F.col("q2"), radius))).select("q1", "q2", "_t.table", "_t.block")
    apart = _apart("q1", "q2", "f1", "f2")
    return keys.join(tables, ["table", "block"]).where(apart <= radius).select("q1", "q2", "f1", "f2", apart.alias("distance"), "copies").distinct()


def near_pairs(prints: DataFrame, radius: int) -> DataFrame:
    """Pairs (a1, a2, b1, b2, distance) of distinct fingerprints (f1, f2) at most ``radius`` bits apart.

    Equal fingerprints are one; a caller joins the pairs back to its rows by (f1, f2).
    """
    found = near_search(prints, prints, radius).where("q1 < f1 or q1 = f1 and q2 < f2")
    return found.select(F.col("q1").alias("a1"), F.col("q2").alias("a2"), F.col("f1").alias("b1"), F.col("f2").alias("b2"), "distance")


# ---------------------------------------------------------------- next document

def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the key, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = F.array(*[F.lit(1 << s) for s in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(table, at + s - 1) < key), at + s).otherwise(at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(bucket, place, guard, doc_id, text, next_text): documents in descending id order inside buckets.

    The rows with ``guard`` = 1 are copies that stand for the row after a bucket's last.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("_key", F.coalesce("doc_id", F.expr("-9223372036854775807L - 1")))
    total = src.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(min(MOST_BUCKETS, 1 + total // bucket_bytes))
    bounds: list[int] = []
    if n > 1:
        cuts = src.agg(F.percentile_approx("_key", [k / n for k in range(1, n)], max(10_000, 10 * n))).first()[0]
        bounds = sorted(set(cuts))
    src = src.withColumn("bucket", _bucket(F.col("_key"), bounds))
    # at most n rows: each bucket's first key goes to the bucket above it, the very first to the lowest
    firsts = src.groupBy("bucket").agg(F.max("_key").alias("_key"))
    order = Window.orderBy("bucket")
    above = firsts.select(F.lead("bucket").over(order).alias("_up"), F.min("bucket").over(order).alias("_low"), "_key") \
        .select("_key", F.coalesce("_up", "_low").alias("_to"))
    guards = src.drop("bucket").join(F.broadcast(above), "_key").groupBy("_to", "_key").agg(F.min("text").alias("text")) \
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "_key", F.col("_to").alias("bucket"), F.lit(1).alias("guard"))
    every = src.withColumn("guard", F.lit(0)).unionByName(guards)
    inside = Window.partitionBy("bucket").orderBy("guard", F.desc("_key"), "text")
    return every.select("bucket", F.row_number().over(inside).alias("place"), "guard", "doc_id", "text", F.lead("text").over(inside).alias("next_text"))


def edited(text: Column, after: Column) -> Column:
    """``text`` with its last third replaced by the first as many characters of ``after``."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(F.coalesce(after, F.lit("")), F.lit(1), cut))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, radius: int = RADIUS,
                       asked: int = ASKED) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module.

    ``n_near``: for ids that ``asked`` divides, how many other documents have a fingerprint
    at most ``radius`` bits apart, by block tables over all documents; null for the others.
    """
    rows = with_next(docs, id_col, text_col, bucket_bytes).withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    digest = F.sha2(F.col("_edited").cast("binary"), 256)
    parts = [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, -10).cast("long").alias(f"_s{k}") for k in range(4)]
    both = F.array(F.struct(F.lit(0).alias("kind"), term_hashes(F.col("text")).alias("h")),
                   F.struct(F.lit(1).alias("kind"), term_hashes(F.col("_edited")).alias("h")))
    keep = ["doc_id", "n_chars", "guard", *[f"_s{k}" for k in range(4)]]
    votes = (rows.select("bucket", "place", "doc_id", "guard", F.length("text").cast("long").alias("n_chars"), *parts, F.explode(both).alias("_x"))
             .select("bucket", "place", *keep, F.col("_x.kind").alias("kind"), F.explode_outer("_x.h").alias("_h"))
             .groupBy("bucket", "place", "kind").agg(*[F.max(c).alias(c) for c in keep], *vote_sums(F.col("_h"))))
    f1, f2 = fingerprint_columns()
    prints = votes.select("bucket", "place", "kind", *keep, f1.alias("_1"), f2.alias("_2"))
    pick = [F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{n}{c}") for k, n in ((0, "f"), (1, "e")) for c in ("_1", "_2")]
    wide = prints.groupBy("bucket", "place").agg(*[F.max(c).alias(c) for c in keep], *pick)
    inside = Window.partitionBy("bucket").orderBy("place")
    wide = wide.withColumns({f"n{c}": F.lead(f"f{c}").over(inside) for c in ("_1", "_2")}).where("guard = 0")
    c = F.col
    out = stage(wide.select("doc_id", "n_chars", F.lower(F.concat(*[F.lpad(F.hex(f"_s{k}"), 16, "0") for k in range(4)])).alias("edited_sha256"),
                            as_text(c("f_1"), c("f_2")).alias("fingerprint"), as_text(c("e_1"), c("e_2")).alias("edited_fingerprint"),
                            likeness(c("f_1"), c("f_2"), c("e_1"), c("e_2")).alias("near_edited"),
                            likeness(c("f_1"), c("f_2"), c("n_1"), c("n_2")).alias("near_next"), c("f_1").alias("f1"), c("f_2").alias("f2")), "fingerprints")
    is_asked = F.coalesce(F.pmod("doc_id", F.lit(asked)) == 0, F.lit(False))
    queries = out.where(is_asked)
    near = near_search(out, queries, radius).groupBy("q1", "q2").agg((F.sum("copies") - 1).alias("n_near"))
    answered = queries.join(near, (F.col("f1") == F.col("q1")) & (F.col("f2") == F.col("q2"))).drop("q1", "q2")
    return answered.unionByName(out.where(~is_asked).withColumn("n_near", F.lit(None).cast("long"))).drop("f1", "f2")
