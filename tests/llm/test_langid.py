import zlib
from collections import Counter

import numpy as np
import pytest

from anthro.llm import langid as L

TRAIN = [(i, t, lang, "x") for i, (t, lang) in enumerate([
    ("the cat and the dog", "en"), ("the house of the king", "en"), ("der hund und die katze", "de"), ("das haus des königs", "de"),
    ("le chat et le chien", "fr"), ("maison élevée", "fr"), ("no language", None), (None, "fr"), ("", "es")])]


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.createDataFrame(TRAIN, "doc_id bigint, text string, lang string, score string"))


def brute(model_langs, text):
    """Word-first backoff from plain counts."""
    words = {k: Counter() for k in model_langs}
    for _, t, lang, _ in TRAIN:
        if lang and t:
            words[lang].update(t.lower().split())
    grams = {k: {n: Counter() for n in range(1, L.LONGEST + 1)} for k in model_langs}
    for k, c in words.items():
        for w, m in c.items():
            s = f" {w} "
            for n in range(1, L.LONGEST + 1):
                for i in range(len(s) - n + 1):
                    grams[k][n][s[i:i + n]] += m

    def score(c, u):
        return max(-L.PENALTY, np.log10(c[u] / sum(c.values()))) if c[u] else -L.PENALTY

    out = np.zeros(len(model_langs))
    ws = text.lower().split()
    for w in ws:
        if any(words[k][w] for k in model_langs):
            out += [score(words[k], w) for k in model_langs]
            continue
        s = f" {w} "
        for n in range(min(L.LONGEST, len(s)), 0, -1):
            found = [g for i in range(len(s) - n + 1) if any(grams[k][n][g := s[i:i + n]] for k in model_langs)]
            if found:
                out += np.mean([[score(grams[k][n], g) for k in model_langs] for g in found], axis=0)
                break
        else:
            out -= L.PENALTY
    return model_langs[int(np.argmax(out))]


def test_matches_plain_counts(spark, model):
    texts = ["the katze", "königin", "hauses", "chien élevé", "kingdom of cats", "zzz", "et", "und the", "maisons dans le chat", "q" * 50000]
    got = {r.doc_id: r for r in L.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    for i, t in enumerate(texts):
        assert got[i].lang_pred == brute(model.langs, t), t
        assert 0 <= got[i].score <= 1


def test_cases(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "the cat"), (5, "the cat"), (5, "the cat"), (6, "the " * 100000)]
    got = L.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[None][0] == by[5][0] == by[6][0] == "en"
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert L.identify(empty, model).count() == 0
    nothing = L.train(empty)
    assert {r.lang_pred for r in L.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from anthro.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op3_language_id"](spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95


def test_words_are_read_as_in_training(spark, model):
    """Whatever is no letter or mark parts words, also beyond ASCII."""
    plain = ["the cat and the dog", "der hund und die katze", "le chat et le chien"]
    odd = ["\u201cthe\u201d\u00a0cat\u3002and\u2014the \u00abdog\u00bb", "der\u2003hund\u2026und\u2019die\uff0ckatze", "le\u00a0chat\u2009et\u00b7le\u3000chien!"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(spark.createDataFrame(list(enumerate(plain + odd)), "doc_id bigint, text string"), model).collect()}
    assert [got[i] for i in range(3)] == [got[i + 3] for i in range(3)]


def test_every_language_keeps_its_share(spark):
    """A language of few texts keeps its words beside one with many."""
    big = [(i, " ".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "klmnopqr" for c in "stuv"), "big") for i in range(50)]
    small = [(1000 + i, "xaxa yoyo zuzu wewe", "small") for i in range(2)]
    m = L.train(spark.createDataFrame(big + small, "doc_id bigint, text string, lang string"), max_units=100)
    assert len(m.hashes) == 50 + 4
    got = L.identify(spark.createDataFrame([(1, "xaxa zuzu"), (2, "akt blu")], "doc_id bigint, text string"), m).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["small", "big"]
