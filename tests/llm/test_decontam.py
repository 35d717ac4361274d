import hashlib
import re

import pytest

from anthro.llm import decontam as D

SCHEMA = "doc_id bigint, text string, extra string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench, window=13, share=20):
    out = set()
    for d, t, *_ in docs:
        w, hit, items = words(t), set(), set()
        for i, b in bench:
            bw = words(b)
            n = min(window, len(bw))
            if not n:
                continue
            grams = {tuple(bw[k:k + n]) for k in range(len(bw) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    items.add(i)
        named = sorted(str(i) for i in items if i is not None)
        out.add((d, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(),
                 len(hit) > 0 and share * len(hit) >= len(w)))
    return out


LONG = " ".join(f"w{i}" for i in range(40))
BENCH = [(1, LONG), (2, "tiny item"), (3, None), (4, ""), (5, "Été à la Plage"), (10, " ".join(["rep"] * 15)), (None, "null id item")]
DOCS = [(1, f"before {LONG} after", "x"), (2, " ".join(f"w{i}" for i in range(5, 18)) + " z" * 300, "x"), (3, None, None), (4, "", "x"),
        (5, "a TINY, item!", "x"), (5, "a TINY, item!", "x"), (None, "été à la plage", "x"), (7, "rep " * 400, "x"),
        (8, "w0 w1 w2", "x"), (9, "nothing here " * 50 + "tiny", "x"), (10, "item tiny", "x"), (11, "null id item yes", "x"),
        (12, "tiny\n" * 20000 + "item", "x")]


@pytest.fixture
def frames(spark):
    return (spark.createDataFrame(DOCS, SCHEMA), spark.createDataFrame(BENCH, "item_id bigint, text string"))


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_matches_brute_force(frames):
    got = D.contamination(*frames)
    assert got.count() == len(DOCS)
    assert rows(got) == brute(DOCS, BENCH)


def test_blocks_give_the_same(frames):
    assert rows(D.contamination(*frames, block_bytes=60)) == brute(DOCS, BENCH)


def test_empty_tables(spark, frames):
    docs, bench = frames
    assert D.contamination(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in D.contamination(docs, bench.limit(0)).collect())


def test_phrase_and_proximity(frames):
    docs, bench = frames
    index = D.build_index(docs)
    got = {(r.doc_id, r.item_id, r.start, r.length) for r in D.phrase_hits(index, bench).collect()}
    assert {(1, "1", 1 + k, 13) for k in range(28)} <= got
    assert (5, "2", 1, 2) in got and not any(d == 10 for d, *_ in got)
    near = {(r.doc_id, r.item_id, r.start, r.length) for r in D.proximity_hits(index, bench, span=5).collect()}
    assert (10, "2", 0, 2) in near and (5, "2", 1, 2) in near and (12, "2", 19999, 2) in near
    assert not any(d == 9 and i == "2" for d, i, *_ in near)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows(D.contamination(docs, bench)) == want
    assert any(x[5] for x in want)


def test_benchmark_of_thirty_megabytes_stays_small_in_a_worker():
    """Windows are places in the word array; what a task holds beside a shard, and makes for one, is bounded."""
    import random
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200_000)]
    texts = [" ".join(rng.choices(vocabulary, k=3_000)) for _ in range(1_500)]
    assert sum(map(len, texts)) > 30 << 20
    shard_texts = [" ".join(rng.choices(vocabulary, k=20_000)) + " " + " ".join(texts[7].split()[100:130]), texts[1_499]]
    tracemalloc.start()
    block = D.Block(list(range(1_500)), texts, 13)
    held = tracemalloc.get_traced_memory()[0]
    w = D.Words(pa.array(shard_texts), D.ALNUM_TABLE)
    order = w.hash.argsort(kind="stable")
    terms, counts = D._runs(w.hash[order])
    shard = D.Shard({"shard": "x", "doc_ids": [1, 2], "first": w.first.astype("<u4").tobytes(), "terms": terms.astype("<u8").tobytes(),
                     "counts": counts.astype("<u4").tobytes(), "positions": order.astype("<u4").tobytes()})
    tracemalloc.reset_peak()
    item, start, length = block.occurrences(shard)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 200 << 20 and peak < 350 << 20
    assert sorted(zip(item.tolist(), start.tolist(), strict=True)) == [(7, 20_000 + i) for i in range(18)] + [(1_499, 20_030 + i) for i in range(2_988)]
    assert set(length.tolist()) == {13}


def test_many_positions_in_parts(frames, monkeypatch):
    monkeypatch.setattr(D, "MOST_WINDOWS", 2)
    monkeypatch.setattr(D, "MOST_POSITIONS", 3)
    import pyarrow as pa

    def found():
        block = D.Block([b[0] for b in BENCH], [b[1] or "" for b in BENCH], 13)
        w = D.Words(pa.array([d[1] for d in DOCS]), D.ALNUM_TABLE)
        order = w.hash.argsort(kind="stable")
        terms, counts = D._runs(w.hash[order])
        shard = D.Shard({"shard": "x", "doc_ids": [d[0] for d in DOCS], "first": w.first.astype("<u4").tobytes(), "terms": terms.astype("<u8").tobytes(),
                         "counts": counts.astype("<u4").tobytes(), "positions": order.astype("<u4").tobytes()})
        return sorted(zip(*[x.tolist() for x in block.occurrences(shard)], strict=True))

    small = found()
    monkeypatch.undo()
    assert small and small == found()
