import numpy as np
import pyarrow as pa
import pytest

from anthro.llm import toxicity as T


def test_fit_recovers_an_ordered_signal():
    rng = np.random.default_rng(1)
    n, f = 3000, 40
    x = rng.random((n, f)) < 0.2
    true = rng.normal(0, 1.5, f)
    z = x @ true + rng.logistic(size=n)
    grade = (z > -1).astype(int) + (z > 1) + (z > 2.5)
    rows, cols = np.nonzero(x)
    w, theta = T.fit_ordinal(rows, cols, grade, f, 4, ridge=0.0, steps=800)
    assert np.corrcoef(w, true)[0, 1] > 0.97
    assert (np.diff(theta) > 0).all() and np.allclose(np.diff(theta), [2, 1.5], atol=0.35)

    def loss(w, theta):
        s = np.bincount(rows, w[cols], n)
        p = np.concatenate([np.ones((n, 1)), T.sigmoid(s[:, None] - theta), np.zeros((n, 1))], axis=1)
        own = p[np.arange(n), grade] - p[np.arange(n), grade + 1]
        return -np.log(np.maximum(own, 1e-12)).mean()

    base = loss(w, theta)
    for _ in range(30):
        assert loss(w + rng.normal(0, 0.05, f), theta + rng.normal(0, 0.05, 3)) > base - 1e-3


def brute_features(text):
    words, word = [], b""
    for c in (text or "").encode():
        if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
        elif word:
            words.append(word)
            word = b""
    if word:
        words.append(word)
    return {("w", w) for w in words} | {(k, w[:k]) for w in words for k in T.BEGINNINGS if len(w) > k}


def test_features():
    texts = ["The idiot, idiotic IDIOT été étés", "", None, "a ab abc abcd abcde abcdef abcdefg", "the the", "x" * 100]
    f, r = T.distinct_per_row(*T.feature_stream(pa.array(texts, pa.string())))
    assert np.bincount(r, minlength=len(texts)).tolist() == [len(brute_features(t)) for t in texts]


DOCS = [(i, f"plain word{i % 7} text number and more" + (" you vileword now" if i % 3 == 0 else "") + (" vileword vilewords vilest horrid horrid" if i % 6 == 0 else ""), 1)
        for i in range(240)] + [(900, None, 1), (901, "", 1), (None, "vileword", 1), (902, "clean text", 1), (902, "clean text", 1), (903, "plain text " * 20000, 1)]


def test_learn_and_score(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, severity int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(0, 240)] + [(None, 1, 0), (7, None, 0), (5000, 1, 0)], "doc_id bigint, toxic int, text int")
    m = T.learn(docs, labels)
    got = T.score(docs, m).collect()
    assert len(got) == len(DOCS)
    by = {r.doc_id: r for r in got}
    assert all((by[i].p_toxic > 0.5) == (i % 3 == 0) for i in range(240))
    assert by[None].p_toxic > 0.5 and all(by[i].p_toxic < 0.5 for i in (900, 901, 902, 903))
    assert np.mean([by[i].severity for i in range(0, 240, 6)]) > np.mean([by[i].severity for i in range(3, 240, 6)]) > 0.5
    assert all(0 <= r.severity <= 2 and r.grade in (0, 1, 2) for r in got)
    kept = T.keep_clean(docs, m)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for d, *_ in DOCS if d is not None and not (d < 240 and d % 3 == 0))


def test_no_labels(spark):
    docs = spark.createDataFrame(DOCS[:5], "doc_id bigint, text string, severity int")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    m = T.learn(docs, none)
    assert {(r.severity, r.grade) for r in T.score(docs, m).collect()} == {(0.0, 0)}
    assert T.keep_clean(docs, m).count() == 5
    assert T.score(docs.limit(0), m).count() == 0
    one = T.learn(docs, spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int"))
    assert T.keep_clean(docs, one).count() == 5


def test_thinned_grade_keeps_the_base_rate(spark):
    """Clean labels far beyond their share of max_docs: probabilities stay those of all labels."""
    texts = [f"plain word{i % 7} text more" + (" vileword" if (i % 10 == 0 and i % 20 < 10 and i % 3) or i % 67 == 0 else "") for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9000, None), (9001, ""), (9002, "unheard of")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(3000)], "doc_id bigint, toxic int")
    whole, thin = T.learn(docs, labels), T.learn(docs, labels, max_docs=600)
    probes = docs.where("doc_id >= 9000 or doc_id in (1, 10)")
    a, b = ({r.doc_id: r for r in T.score(probes, m).collect()} for m in (whole, thin))
    odds = {k: [np.log(x[k].p_toxic / (1 - x[k].p_toxic)) for x in (a, b)] for k in a}
    assert all(abs(y - x) < 1.0 for x, y in odds.values()), odds
    assert all(not a[k].toxic and not b[k].toxic for k in (9000, 9001, 9002))
    assert {r.doc_id for r in T.keep_clean(probes, thin).collect()} >= {9000, 9001, 9002}


def test_held_out(spark):
    """Learn from two thirds of the labels, judge the rest."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    m = T.learn(docs, labels.where("doc_id % 3 != 0"))
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id % 3 = 0").collect()}
    got = {r.doc_id: r.toxic for r in T.score(docs, m).collect() if r.doc_id in truth}
    hit = np.mean([got[d] for d in got if truth[d] == 1])
    wrong = np.mean([got[d] for d in got if truth[d] == 0])
    print(hit, wrong)
    assert hit > 0.85 and wrong < 0.02
