import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anthro.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, reference, limit=P.LIMIT):
    """Every id in exactly one piece, pieces contiguous, sequences gapless and full enough; padding share."""
    seqs, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append(r)
    used = room = 0
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at and n > 0
            at += n
        assert at <= limit
        used, room = used + at, room + P.padded(at, limit)
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(ids_of(reference, t))
    assert set(want) == set(per_doc)
    for d, lists in want.items():
        got = [x for r in sorted(per_doc[d], key=lambda r: (r.sequence_id, r.offset)) for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert sorted(got) == sorted(x for y in lists for x in y)
        if len(lists) == 1:
            assert got == lists[0]
            assert {r.doc_tokens for r in per_doc[d]} == {len(got)}
            at = 0
            for r in sorted(per_doc[d], key=lambda r: r.start):
                assert r.start == at and r.length * 4 == len(r.ids)
                at += r.length
    assert used == sum(len(y) for x in want.values() for y in x)
    return room / max(used, 1)


@pytest.mark.parametrize("text", [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "one\n two", "x\t\n y", "don't 's  we'll", "été ü ñ 汉字 тест", "a  b  c", "\n\n", "a <|endoftext|> b",
    "<|endoftext|>", "tabs\tand\x0bmore \x1c x", "1234 5.6% $$$ !!!", "long" * 500, "é ​ z", "a\u0085 b c  d"])
def test_ids_equal_the_tokenizer(reference, text):
    got = np.frombuffer(P.tokenizer(PATH).encode(text), "<u4").tolist()
    assert got == reference.encode(text, add_special_tokens=False).ids


def test_random_texts_equal_the_tokenizer(reference):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "Word", "é", "'s", "'", ".", "!", "12", " ", "汉", "\r\n", "\x1f"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert np.frombuffer(P.tokenizer(PATH).encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def brute_cost(points, costs, limit):
    best = [0] + [None] * (len(points) - 1)
    for j in range(1, len(points)):
        best[j] = min(best[i] + costs[j] + P.padded(points[j] - points[i], limit) - (points[j] - points[i])
                      for i in range(j) if points[j] - points[i] <= limit)
    return best[-1]


def test_cuts_are_optimal():
    rng = np.random.default_rng(5)
    for limit in (8, 20, 32):
        for _ in range(60):
            points = np.concatenate([[0], np.cumsum(rng.integers(1, min(limit, 9), rng.integers(1, 40)))])
            costs = rng.choice([0, 2, 7], len(points))
            cuts = P.best_cuts(points, costs, limit)
            got = sum(int(costs[b]) + P.padded(int(points[b] - points[a]), limit) - int(points[b] - points[a]) for a, b in zip(cuts, cuts[1:]))
            assert got == brute_cost(points.tolist(), costs.tolist(), limit)


def test_cases(spark, reference):
    docs = [(1, "One. Two two. Three!"), (2, None), (3, ""), (None, "no id"), (5, "word " * 9000), (6, "same"), (6, "same"), (7, "x" * 30000),
            (8, " ".join(f"Sentence {i} ends here." for i in range(4000)))]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, offset int").coalesce(1)
    assert check(P.pack_documents(df, PATH).collect(), docs, reference) < 1.05
    assert check(P.pack_documents(df, PATH, block=3000).collect(), docs, reference) < 1.05
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_whole_table(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    rows = P.pack_documents(df, PATH).collect()
    assert check(rows, [(r.doc_id, r.text) for r in df.collect()], reference) < 1.01


def test_query_digest(spark):
    from anthro.llm.queries import QUERIES

    df = QUERIES["op6_packing"](spark, "/root/testdata/sf0.001")
    assert df.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    base = P.pack_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH)
    assert {(r.doc_id, r.start): zlib.crc32(r.ids) for r in base.collect()} == {(r.doc_id, r.start): r.ids_crc32 for r in df.collect()}


def test_a_text_is_encoded_in_one_call():
    """Not word by word, which takes twice the time where words seldom come again."""
    calls = []

    class Counted:
        def __init__(self, bpe):
            self.bpe = bpe

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.bpe, name)

    bpe = P.ByteBpe(PATH)
    text = " ".join(f"word{i}x" for i in range(3000))
    want = bpe.encode(text)
    bpe._bpe = Counted(bpe._bpe)
    assert P.ByteBpe(PATH).encode(text) == want == bpe.encode(text) and len(calls) == 1
