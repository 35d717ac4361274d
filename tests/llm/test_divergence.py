import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from anthro.llm import divergence as D

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n int"


def share(c, n):
    return 1 + 10 ** 9 * (c + 1) // n


def brute(docs, least=3, most=200):
    df, count, langs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for _, t, lang, s, *_ in docs:
        lang, s = lang or "", s or ""
        w = Counter(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")))
        groups.add((lang, s))
        df[lang].update(w.keys())
        count[lang, s].update(w)
        langs[lang].update(w)
    out = []
    for lang, s in groups:
        kept = sorted(x for x, n in df[lang].items() if n >= least)
        v = len(kept)

        def dist(c, kept=kept, v=v):
            n = sum(c[x] for x in kept) + v
            return [share(c[x], n) for x in kept]

        p, q = dist(count[lang, s]), dist(langs[lang])
        pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p, dist(count[lang, o]), strict=True))) for g, o in groups if g == lang and o != s]
        terms = [(x, (a - b) ** 2 // b) for x, a, b in zip(kept, p, q, strict=True) if count[lang, s][x] and a > b]
        for part, rows in (("pair", pairs), ("term", terms)):
            rows.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, s, part, i, val, k + 1) for k, (i, val) in enumerate(rows) if part == "pair" or k < most]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "ijklmnéß"]
    docs = []
    for i in range(n):
        s = rng.choice(["s0"] * 6 + [f"s{k}" for k in range(1, 7)])
        w = [rng.choice(words[:20 + 5 * int(s[1:])]) for _ in range(rng.randrange(30))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 7 == 0 else " 3".join(w), rng.choice(["en", "de", "de", None]), s, "x", 1))
    return docs + [(900, None, "en", "s0", None, None), (901, "", "fr", "only", "x", 1), (902, "!!", "fr", None, "x", 1), (903, "a a a", "xx", "alone", "x", 1),
                   (904, "Été " * 40_000 + "ij", "en", None, "x", 1), (905, "Éa éa", "en", "s1", "x", 1)] + docs[:2] * 2


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, SCHEMA)
    assert rows(D.audit(df)) == brute(docs)
    assert rows(D.audit(df, most_terms=5, least_docs=2, broadcast_groups=0)) == brute(docs, 2, 5)


def test_small_buffers_give_the_same(spark, monkeypatch):
    docs = corpus(3)
    for name, value in (("HELD_ROWS", 8), ("PAIRS", 3)):
        monkeypatch.setattr(D, name, value)
    sums = D.PairSums()
    rng = np.random.default_rng(5)
    sizes = np.array([1, 4, 2, 6, 1])
    code, p, p0 = rng.integers(0, 4, 14), rng.integers(1, 10 ** 9, 14), rng.integers(1, 9, 14)
    sums.add(code, p, p0, sizes)
    want, lo = Counter(), 0
    for k in sizes.tolist():
        for i in range(lo, lo + k):
            for j in range(lo, lo + k):
                if i != j:
                    f = lambda a, b: (int(a) - int(b)) ** 2 // int(b)
                    want[code[i], code[j]] += f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
        lo += k
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(v) for k, v in zip(sums.key, sums.value, strict=True)} == want
    table = D._added_up([D.group_counts(*[__import__("pyarrow").array(x) for x in (["a", "b", "a"], ["s", "s", "s"], ["x y x", "x", None])])] * 2)
    assert sorted(map(tuple, (r.values() for r in table.to_pylist()))) == [("a", "s", "x", 4, 2), ("a", "s", "y", 2, 2), ("b", "s", "x", 2, 2)]
    assert rows(D.audit(spark.createDataFrame(docs, SCHEMA))) == brute(docs)


def test_shares_are_exact_for_large_counts(spark):
    n = [0, 1, 10 ** 6, 3 * 10 ** 12, 8 * 10 ** 13 - 1]
    for total in (1, 7, 10 ** 9 + 7, 8 * 10 ** 13):
        want = [share(c, total) for c in n if c < total]
        assert D._share(np.array(n[:len(want)]), np.array(total)).tolist() == want
        got = spark.createDataFrame([(c, total) for c in n[:len(want)]], "c bigint, t bigint").selectExpr(D._share_sql("c", "t") + " AS p").collect()
        assert [r.p for r in got] == want


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], SCHEMA)).count() == 0
