import hashlib
import random

import pytest
from pyspark.sql import functions as F

from anthro.llm import simhash as S


def brute(docs):
    rows = sorted(((-(2**63) if d is None else d, t or "", d) for d, t in docs), key=lambda r: (-r[0], r[1]))
    out = []
    for i, (_, t, d) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        cut = len(t) // 3
        e = t[:len(t) - cut] + nxt[:cut]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, nxt))
    return out


@pytest.mark.parametrize("bucket_bytes", [1 << 22, 700])
def test_edited_texts_and_likeness(spark, bucket_bytes):
    rng = random.Random(2)
    docs = [(i * 7, " ".join(rng.choice(["un", "été", "汉字", "𝄞x", "foo", "Bar"]) for _ in range(rng.randrange(0, 40)))) for i in range(80)]
    docs += [(1000, None), (1001, ""), (1002, "same text here"), (1003, "same text here"), (None, "no id"), (5, "dup"), (5, "dup"), (5, "other"), (1004, "w " * 40000)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(d, t, 3, 4) for d, t in docs], "doc_id bigint, text string, bucket int, place int")
    got = S.fingerprint_report(df, bucket_bytes=bucket_bytes).collect()
    want = brute(docs)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted((w[:3] for w in want), key=key)
    texts = sorted({x for w in want for x in w[3:]})
    prints = {}
    rows = S.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).select("doc_id", S.as_text(F.col("f1"), F.col("f2")).alias("f")).collect()
    for r in rows:
        prints[texts[r.doc_id]] = r.f
    near = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
    have = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}
    for d, n, sha, t, e, nxt in want:
        r = have[(d, n, sha)]
        assert (r.fingerprint, r.edited_fingerprint) == (prints[t], prints[e])
        assert r.near_edited == pytest.approx(near(prints[t], prints[e]))
        if (d, t) not in {(5, "dup")}:
            assert r.near_next == pytest.approx(near(prints[t], prints[nxt]))
    assert prints[""] == "0" * 32


def test_votes(spark):
    df = spark.createDataFrame([(1, "a b c a b d")], "doc_id bigint, text string")
    h = df.select(S.term_hashes(F.col("text")).alias("h"), F.transform(S.term_hashes(F.col("text")), lambda x: F.xxhash64(x, F.lit(1))).alias("g")).first()
    assert len(h.h) == 6 and len(set(h.h)) == 5
    want = [sum(1 << i for i in range(64) if 2 * sum((x >> i) & 1 for x in s) > 6) for s in (h.h, h.g)]
    r = S.fingerprints(df).first()
    assert [r.f1 & (2**64 - 1), r.f2 & (2**64 - 1)] == want


@pytest.mark.parametrize("radius", [0, 3, 9])
def test_pairs_within_radius(spark, radius):
    rng = random.Random(radius)
    prints = []
    for _ in range(30):
        f = rng.getrandbits(128)
        for _ in range(5):
            g = f
            for b in rng.sample(range(128), rng.randrange(0, 12)):
                g ^= 1 << b
            prints.append(g)
    prints += prints[:4] + [0, 1, 2**127]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(p >> 64), signed(p & (2**64 - 1))) for p in prints] + [(None, None)], "f1 bigint, f2 bigint")
    got = {frozenset(((r.a1 & (2**64 - 1)) << 64 | (r.a2 & (2**64 - 1)), (r.b1 & (2**64 - 1)) << 64 | (r.b2 & (2**64 - 1)))) for r in S.near_pairs(df, radius).collect()}
    u = sorted(set(prints))
    assert got == {frozenset((a, b)) for i, a in enumerate(u) for b in u[i + 1:] if bin(a ^ b).count("1") <= radius}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.fingerprint_report(df).count() == 0 and S.fingerprints(df).count() == 0


def test_whole_table(spark):
    from anthro.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op4_fingerprints"](spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in rows} == {w[:3] for w in brute(docs)}
    prints = [int(r.fingerprint, 16) for r in rows]
    for r in rows:
        near = sum(bin(int(r.fingerprint, 16) ^ p).count("1") <= S.RADIUS for p in prints) - 1 if r.doc_id % 50 == 0 else None
        assert r.n_near == near
    assert any(r.n_near for r in rows)
    long = [r for r in rows if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in long) / len(long) > 0.97
