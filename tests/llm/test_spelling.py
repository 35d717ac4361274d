import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from anthro.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id bigint, text string, word string, n int"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, modulus=None, least_length=5, least_count=3):
    n = Counter()
    for d, t, *_ in docs:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if modulus and h % modulus == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    form, near = {}, {}
    for w, k in n.items():
        near[w] = sorted(((-n[x], x) for x in n if one_edit(w, x)), key=lambda x: (x[0], [ord(c) for c in x[1]]))
        if near[w] and -near[w][0][0] >= 2 * k:
            form[w] = near[w][0][1]

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items())


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcéÿ×ß"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 11))) for _ in range(25)]
    docs = []
    for i in range(60):
        out = []
        for _ in range(60):
            w = list(words[int(len(words) * rng.random() ** 2)])
            if rng.random() < 0.5:
                k = rng.randrange(len(w))
                w[k:k + rng.randrange(2)] = rng.choice(["", rng.choice(letters), rng.choice(letters) * 2])
            out.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        docs.append((i, rng.choice([" ", "-", "7", "漢", "\U0001F600"]).join(out), "x", 1))
    return docs + [(None, docs[0][1], "x", 1), (1, None, None, None), (2, "", "x", 1), (3, docs[3][1], "x", 1), (3, docs[3][1], "x", 1),
                   (4, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa " * 2, "x", 1), (5, "abcde " * 50_000, "x", 1)]


@pytest.mark.parametrize("seed, modulus, cuts", [(1, None, 3), (2, 7, 3), (3, 97, 2), (4, 2, 1)])
def test_matches_brute_force(spark, seed, modulus, cuts):
    docs = corpus(seed)
    got = S.variants(spark.createDataFrame(docs, SCHEMA), noise_modulus=modulus, cuts=cuts)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, modulus)


def test_pairs_are_found_once(spark):
    docs = corpus(9)
    words = S.word_counts(spark.createDataFrame(docs, SCHEMA), least_length=1, least_count=1)
    pairs = [tuple(r) for r in S.near_pairs(words).select("a", "b").collect()]
    have = [r.word for r in words.collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in have for b in have if one_edit(a, b)}


def test_crc_and_runs():
    texts = ["AbÀĀc", "", None, "xÿy z", "×÷"]
    w = S.runs_of(pa.array(texts))
    runs = [w.word(i).decode() for i in range(len(w.start))]
    assert runs == [x.lower() if x.isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in x) for t in texts for x in RUN.findall(t or "")]
    import numpy as np

    got = S.crc_after(np.full(len(runs), zlib.crc32(b"12:"), np.uint32), w, np.arange(len(runs)))
    assert got.tolist() == [zlib.crc32(f"12:{r}".encode()) for r in runs]


def test_roots_without_broadcast(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 50 else None) for i in range(51)] + [("a", "w0"), ("b", None)]
    df = spark.createDataFrame(chain, "word string, form string")
    got = {r.word: r.root for r in S.roots(df, broadcast_words=1).collect()}
    assert got == {w: "w50" for w, f in chain if f}


def test_empty_table(spark):
    assert S.variants(spark.createDataFrame([], SCHEMA), noise_modulus=97).count() == 0
