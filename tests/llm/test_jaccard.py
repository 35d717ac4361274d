import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anthro.llm import jaccard as J
from anthro.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, n=3):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_token = {}
    for i, s in enumerate(sets):
        for x in s:
            by_token.setdefault(x, []).append(i)
    tried = set()
    for group in by_token.values():
        for n, i in enumerate(group):
            for j in group[n + 1:]:
                if (i, j) not in tried:
                    tried.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        a, b = find(i), find(j)
                        parent[max(a, b)] = min(a, b)
    out = []
    for i, (d, _) in enumerate(docs):
        same = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None] if sets[i] else [d]
        out.append((d, len(sets[i]), min(same, default=None)))
    return sorted(out, key=str)


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id bigint, text string, key int, token string")
    return sorted((tuple(r) for r in J.near_duplicates(df, **more).collect()), key=str)


def test_cases(spark):
    base = [f"b{i}" for i in range(60)]
    docs = [(10, " ".join(base)), (11, " ".join(base[:-1])), (12, " ".join(base[:-1] + ["Z"])), (13, "One two"), (14, "ONE\ttwo"), (15, "one  two three"),
            (16, None), (17, ""), (18, "  \n "), (None, "one two"), (None, "alone here now"), (20, "x"), (21, "x"), (21, "x"), (22, "one two two"),
            (23, "w " * 50000), (24, "w w w w")]
    assert run(spark, docs) == brute(docs)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert J.near_duplicates(df).count() == 0
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("seed,most", [(1, 4), (2, 4), (3, 1)])
def test_random_edits(spark, seed, most):
    """Chains of edits around the threshold, a hot passage, groups of copies."""
    rng = random.Random(seed)
    hot = [f"h{i}" for i in range(40)]
    docs, at = [], 0
    for _ in range(14):
        now = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(3, 120))] + (hot if rng.random() < 0.5 else [])
        for _ in range(rng.randrange(1, 22)):
            docs.append((at, " ".join(now)))
            at += 1
            for _ in range(rng.randrange(0, 3)):
                if rng.random() < 0.5:
                    now = [*now]
                    now[rng.randrange(len(now))] = f"e{rng.randrange(1000)}"
    docs += [(1000 + i, " ".join([f"u{i}", f"u{i}x", *hot])) for i in range(60)]
    rng.shuffle(docs)
    assert run(spark, docs, most_shared=most, sketch_bits=14) == brute(docs)


def cheapest(lengths, n, percent=90):
    """The need of least cost, from the lengths of a set's lists in prefix order."""
    least = -(-percent * n // 100)
    cost = {}
    for k in range(1, min(J.MOST_SHARED, least) + 1):
        m = min(n, n - least + k)
        read = sum(x - 1 for x in lengths[:m])
        cost[k] = m + read + J.VERIFY_COST * (read + J.CHANCE * m * J.SAME ** (k - 1))
    return min(cost, key=lambda k: (cost[k], k))


def test_need_is_the_cheapest(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for key in range(80):
        n = rng.randrange(1, 60)
        lengths = sorted(rng.choice([1, 1, 1, 2, 3, 50]) for _ in range(n))
        most = min(n, n - -(-90 * n // 100) + J.MOST_SHARED)
        # lists of one set are not stored
        rows += [(key * 100 + i, key, n, i, x) for i, x in enumerate(lengths[:most]) if x > 1]
        if any(x > 1 for x in lengths[:most]):
            want[key] = cheapest(lengths, n)
    df = spark.createDataFrame(rows, "token bigint, key bigint, n int, pos int, length bigint")
    got = {r.key: r.need for r in J.choose_need(df, 90).select("key", "need").distinct().collect()}
    assert got == want and len(set(want.values())) > 1


def needs(spark, docs, sketch=None):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    lists = J.posting_lists(J.prefixes(df, sketch or J.shingle_sets(df, 3, "doc_id", "text")[1], 3, 90, "text"), 90)
    return {(r.key, r.need) for r in lists.select("key", "need").distinct().collect()}


def test_need_does_not_change_with_unrelated_documents(spark):
    """In one order of shingles, a thousand times as many unrelated ones change neither the lists of a document nor its choice."""
    rng = random.Random(8)
    hot = " ".join(f"h{i}" for i in range(30))
    docs = [(i, f"{hot} " + " ".join(f"v{rng.randrange(4)}" for _ in range(rng.randrange(3, 40)))) for i in range(40)]
    sketch = J.shingle_sets(spark.createDataFrame(docs, "doc_id bigint, text string"), 3, "doc_id", "text")[1]
    before = needs(spark, docs, sketch)
    size = sum(len(t.split()) for _, t in docs)
    more = [(1000 + i, " ".join(f"x{i}y{j}" for j in range(2_000))) for i in range(1000 * size // 2_000)]
    assert needs(spark, docs + more, sketch) == before and len({n for _, n in before}) > 1


def test_groups_beyond_broadcast(spark):
    """Hot keys and groups by broadcast, the others by shuffle: the same rows."""
    docs = [(i, "one text that many hold " + "x" * (i % 3)) for i in range(60)] + [(100 + i, f"{i // 2} alone with few words") for i in range(30)]
    words = [f"w{i}" for i in range(60)]
    docs += [(200 + i, " ".join([*words[:i], f"e{i}", *words[i + 1:]])) for i in range(0, 60, 2)] + [(300, " ".join(words)), (None, "null id"), (None, "null id")]
    assert run(spark, docs, broadcast_keys=3) == brute(docs) == run(spark, docs)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.vertex: r.root for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {v: r for v, r in got.items() if v != r} == {v: find(v) for v in linked if find(v) != v}


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = sorted((tuple(r) for r in J.near_duplicates(df).collect()), key=str)
    assert got == want
    assert sum(d != c for d, _, c in got) > 20


def test_shingle_order_does_not_depend_on_place():
    """How common a shingle is comes out the same after any other words."""
    import numpy as np
    import pyarrow as pa

    from anthro.llm.jaccard import Sketch
    from anthro.llm.textnum import SPACE_TABLE, Words, run_sums

    rng = np.random.default_rng(7)
    counters = rng.integers(0, 2000, (3, 1 << 12))
    counters[2, rng.random(1 << 12) < 0.3] = 2 ** 40
    sketch = Sketch(Sketch.log_counts(counters))
    assert (abs(sketch._counts(sketch.logs[:2]) - counters[:2]) <= 1).all()
    text = " ".join(f"w{x}" for x in rng.zipf(1.3, 60_000) % 5000)
    words = Words(pa.array([text]), SPACE_TABLE)
    weight = sketch.weight(words.hash)
    direct = sum(weight[k:len(weight) - 2 + k] for k in range(3))
    assert (run_sums(words, weight, 3) == direct).all()


def test_counters_are_sent_packed():
    x = np.random.default_rng(3).poisson(1.2, J.SEGMENT).astype(np.uint16)
    x[:3] = 65_535, 256, 0
    raw = J.packed(x)
    assert (J.unpacked(pa.py_buffer(raw), len(x)) == x).all() and 4 * len(raw) < x.nbytes


def chained(n):
    """Texts of few frequent words, so that a pair must share several shingles."""
    rng = random.Random(12)
    base = [[f"c{rng.randrange(12)}" for _ in range(80)] for _ in range(n // 4)]
    docs = []
    for i in range(n):
        w = list(base[i % len(base)])
        w[rng.randrange(len(w))] = f"c{rng.randrange(12)}"
        docs.append((i, " ".join(w)))
    return docs


def test_lists_are_the_same_sent_or_joined(spark):
    df = spark.createDataFrame(chained(60), "doc_id bigint, text string")
    postings = J.prefixes(df, J.shingle_sets(df, 3, "doc_id", "text")[1], 3, 90, "text")
    sent, joined = (sorted(map(tuple, J.posting_lists(postings, 90, sent_tokens=k).collect()), key=str) for k in (J.SENT_TOKENS, 0))
    assert sent == joined and sent


def test_no_join_gives_list_entries_of_pairs(spark):
    """Tokens of a set are one row before they are joined: else the rows made grow with pairs times list entries."""
    df = spark.createDataFrame(chained(60), "doc_id bigint, text string")
    lists = J.posting_lists(J.prefixes(df, J.shingle_sets(df, 3, "doc_id", "text")[1], 3, 90, "text"), 90)
    placed = lists.drop("is_hub").withColumn("root", F.col("key"))
    assert lists.where("need > 1").count()
    across = J.pairs_across(placed, lists, 90)
    joins = [x for x in across._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert len(joins) == 2 and not any("(key#" in x for x in joins)
    tokens = {}
    for r in lists.collect():
        tokens.setdefault(r.key, (r.need, set()))[1].add(r.token)
    got = {tuple(r) for r in across.collect()}
    assert got and all(len(tokens[a][1] & tokens[b][1]) >= min(tokens[a][0], tokens[b][0]) for a, b in got)


@pytest.mark.parametrize("times", [1, 2])
def test_members_are_not_shuffled_unless_they_repeat(spark, times, monkeypatch):
    """One row a key, stored; what the verification joins is a scan, so that a hot key can be split."""
    made = []
    monkeypatch.setattr(J, "stage", lambda df, name, stage=J.stage: made.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or stage(df, name))
    docs = chained(40)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    df = df.unionByName(df) if times == 2 else df
    sets, _ = J.shingle_sets(df, 3, "doc_id", "text")
    keys = sorted({r.key for r in sets.collect()})
    pairs = spark.createDataFrame([(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]], "a bigint, b bigint")
    members = J.member_sets(df, sets, pairs, 3, "doc_id", "text")
    assert "Aggregate" not in members._jdf.queryExecution().optimizedPlan().toString()
    stored = [plan for name, plan in made if name == "member-sets"]
    assert len(stored) == times and not stored[0].startswith("Aggregate")
    assert sorted(r.key for r in members.collect()) == keys
    texts = {r.doc_id: r.key for r in sets.collect()}
    want = set()
    for i, t in docs:
        for j, u in docs:
            x, y = shingles(t), shingles(u)
            if texts[i] < texts[j] and 100 * len(x & y) >= 90 * len(x | y):
                want.add((texts[i], texts[j]))
    assert {tuple(r) for r in J.verify(pairs, members, 90).collect()} == want
