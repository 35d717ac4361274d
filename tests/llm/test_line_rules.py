import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from anthro.llm import line_rules as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string, line string, _text int"


def low(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def brute(docs, max_docs, max_share):
    held, hosts = defaultdict(set), defaultdict(set)
    for _, t, s, *_ in docs:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                held[s, " ".join(WORD.findall(low(x)))].add(t)
                hosts[s].add(t)
    common = {k for k, v in held.items() if len(v) > max_docs and 10000 * len(v) > max_share * len(hosts[k[0]])}
    out = []
    for d, t, s, *_ in docs:
        t = t or ""
        w = WORD.findall(t)
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = [x for x in lines if (s, " ".join(WORD.findall(low(x)))) in common]
        lost = sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        depleted = 100 * (len(w) - lost) < 50 * len(w) or len(w) - lost < 10
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), sum(n - 1 for n in Counter(lines).values()), len(rep), len(lines),
                    len(gone), lost, failed, not failed and not depleted))
    return sorted(out, key=str)


BASE = "one two three four five six seven eight nine ten"
DOCS = [(i, f"Menu  Home\t| About\n{BASE} a{i}\nmenu home | about\nlast{i}", "h", "x", 1) for i in range(8)]
DOCS += [(20 + i, f"{BASE} {BASE[::-1]}\nshared by two of one host {i // 2}", "h", "x", 1) for i in range(4)]
DOCS += [(30, DOCS[0][1], "other", "x", 1), (30, DOCS[0][1], "other", "x", 1), (31, None, "h", None, None), (32, "", None, None, None), (33, " \n\t\n", "h", "x", 1),
         (34, "word " * 60_000, "h", "x", 1), (35, "a b c d e a b c d e f g h i j k l m n o p q r s t u v w x y z " * 1, None, "x", 1),
         (None, BASE + "\n# $ <b> é ü", None, "x", 1), (36, "\n".join(["Same line here"] * 40), "h", "x", 1), (37, "x\r\ny\x0bz", "h", "x", 1)]
DOCS += [(100 + i, f"copied page with more than ten words in it to pass all\nmenu home | about\n{i // 20}", "copies", "x", 1) for i in range(40)]


@pytest.mark.parametrize("max_docs, max_share", [(3, 0), (1, 2000), (10, 5)])
@pytest.mark.parametrize("broadcast_lines", [1_000_000, 2])
def test_matches_brute_force(spark, max_docs, max_share, broadcast_lines):
    df = spark.createDataFrame(DOCS, SCHEMA)
    got = L.verdicts(df, max_docs=max_docs, max_share=max_share, broadcast_lines=broadcast_lines)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(DOCS, max_docs, max_share)


def test_clean_removes_lines_and_documents(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    got = L.clean(df, max_docs=3, max_share=0)
    assert got.columns == df.columns
    want = Counter()
    kept = {r[0]: r for r in brute(DOCS, 3, 0) if r[10]}
    for d, t, s, x, y in DOCS:
        if d in kept:
            lines = t.split("\n")
            if kept[d][7]:
                lines = [z for z in lines if " ".join(WORD.findall(low(z))) != "menu home | about" or s != "h"]
            want[d, "\n".join(lines), s, x, y] += 1
    assert Counter(tuple(r) for r in got.collect()) == want


def test_no_python_and_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert L.verdicts(df).count() == 0 and L.clean(df).count() == 0
    plan = L.verdicts(spark.createDataFrame(DOCS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_text_of_many_shared_lines(spark):
    long = "\n".join(f"line number {i}" for i in range(30_000))
    df = spark.createDataFrame([(i, f"{long}\nmine {i}", "h") for i in range(4)], "doc_id bigint, text string, source string").repartition(2)
    rows = L.verdicts(df, max_docs=3, max_share=0).select("n_removed_lines", "kept").distinct().collect()
    assert [tuple(r) for r in rows] == [(30_000, False)]
    assert L.clean(df, max_docs=4, max_share=0).where(F.length("text") > 1000).count() == 4
