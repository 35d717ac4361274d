import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from anthro.llm import pii
from test_decontam import brute as contamination
from test_jaccard import brute as near
from test_packing import ids_of

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage over a whole table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, step in C.STAGES:
        before = docs
        docs = C.stage(step(spark, docs, SF), name)
        out.append((name, before.collect(), docs.collect(), docs.columns))
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii_surrogates", "packing"]
    assert all(s[3] == COLUMNS for s in stages[:-1])


def test_toxic_documents_go(stages, spark):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    marks = re.compile(r"\b(idiot|moron|stupid|scum|loser|trash|clown|pathetic|worthless|disgusting)\b", re.I)
    toxic = {r.doc_id for r in before if len(marks.findall(r.text or "")) >= 2}
    clean = {d for d, t in labels.items() if t == 0}
    assert toxic and len(toxic & kept) <= 0.05 * len(toxic)
    assert len(clean - kept) <= 0.02 * len(clean)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def brute_groups(rows):
    import test_jaccard

    plain = test_jaccard.shingles
    test_jaccard.shingles = lambda t, n=5: plain(t, 5)
    try:
        return near([(r.doc_id, r.text) for r in rows], percent=80)
    finally:
        test_jaccard.shingles = plain


def test_one_of_each_group(stages):
    _, before, after, _ = stages[1]
    assert sorted(r.doc_id for r in after) == sorted(d for d, n, c in brute_groups(before) if n == 0 or d == c)


def test_contaminated_documents_go(stages, spark):
    _, before, after, _ = stages[2]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {x[0] for x in contamination([(r.doc_id, r.text) for r in before], bench) if x[5]}
    assert bad and {r.doc_id for r in after} == {r.doc_id for r in before} - bad


def test_private_data_is_replaced(stages):
    _, before, after, _ = stages[3]
    new = {r.doc_id: r for r in after}
    assert len(new) == len(before)
    for r in before:
        old = {v for _, _, _, v in pii.find(r.text)}
        assert not old & {v for _, _, _, v in pii.find(new[r.doc_id].text)}
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text) and (old or r.text == new[r.doc_id].text)


def test_all_tokens_are_packed(stages):
    from tokenizers import Tokenizer

    _, before, after, _ = stages[4]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter({r.doc_id: len(ids_of(tok, r.text)) for r in before})
    got = Counter()
    for r in after:
        got[r.doc_id] += r.length
    assert got == want
    used = Counter()
    for r in after:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_run(spark, stages):
    rows = C.run(spark, SF)
    assert rows.select("doc_id").distinct().count() == len({r.doc_id for r in stages[-1][2]})


CASES = [(1, "a b c d e f g h i j", None, "s", 19), (1, "a b c d e f g h i j", None, "s", 19), (2, "a b c d e f g h i j", "en", "s", 19), (3, None, None, None, None),
         (3, None, None, None, None), (4, "", "en", "s", 0), (None, "k l m n o p q r s t", "en", None, 19), (6, "k l m n o p q r s t", "en", "s", 19),
         (7, "word " * 30000, "en", "s", 150000)]


def test_null_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame(CASES, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("key", F.lit(1)).withColumn("root", F.lit("x"))
    one = C.drop_near_copies(spark, docs, SF)
    assert one.columns == docs.columns
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted([1, 3, 3, 4, 6, 7], key=str)
    assert sorted((r.doc_id for r in C.drop_contaminated(spark, docs, SF).collect()), key=str) == sorted((c[0] for c in CASES), key=str)
    assert len(C.drop_toxic(spark, docs, SF).collect()) == len(CASES)
    none = docs.limit(0)
    for _, step in C.STAGES:
        assert step(spark, none, SF).count() == 0
