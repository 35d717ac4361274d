import re

import pytest

from anthro.llm import pii as P

KEY = b"k" * 32
ROWS = [(1, "Mail thwhhe.68@mail2.example.com or call +1 (499) 555-6503%%% now."), (2, "call +1-499-555-6503, card 4111 1111 1111 1111 or 4111111111111111"),
        (3, 'x token = "1eb9c654e721b4f812088970e66a6345cee33dd6"### 174.91.180.241 erau 10.1.2.3!!'), (4, None), (5, ""), (None, "THWHHE.68@MAIL2.EXAMPLE.COM"),
        (6, "Mrs. Mary Smith met Mr Smith and John Miller."), (6, "Mrs. Mary Smith met Mr Smith and John Miller."), (7, "nothing private 2.0. v1.2.3 of 1999"),
        (8, "г-жа Анна Белова, SSN 123-45-6789"), (9, "word " * 30000 + "a@b.org")]


def entity_kinds(text):
    return [(k, text[s:e]) for s, e, k, _ in P.find(text)]


def test_detection():
    assert entity_kinds(ROWS[0][1]) == [("email", "thwhhe.68@mail2.example.com"), ("phone", "+1 (499) 555-6503")]
    assert [k for k, _ in entity_kinds(ROWS[1][1])] == ["phone", "card", "card"]
    assert entity_kinds(ROWS[2][1]) == [("secret", "1eb9c654e721b4f812088970e66a6345cee33dd6"), ("ip", "174.91.180.241"), ("ip", "10.1.2.3")]
    assert entity_kinds(ROWS[6][1]) == [("given-f", "Mary"), ("family", "Smith"), ("family", "Smith"), ("given-m", "John"), ("family", "Miller")]
    assert entity_kinds("4465758382889437 4465758382889437 x") == [("card", "4465758382889437")] * 2
    assert not P.find(ROWS[8][1]) and not P.find("") and not P.find("mr smith the martin")


def shape(t):
    return re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", t))


def test_form_is_kept():
    for _, text in ROWS:
        new, n = P.rewrite(text, KEY, {})
        assert n == len(P.find(text or ""))
        for (s, e, k, v), (k2, got) in zip(P.find(text or ""), entity_kinds(new or ""), strict=True):
            old = text[s:e]
            assert k == k2 and (got != old or k.startswith("given") or k == "family")  # single draws of names may meet; corpus draws are checked below
            if k in ("phone", "card", "ssn", "email"):
                assert shape(got) == shape(old)
            if k == "card":
                assert P.luhn(re.sub(r"\D", "", got)) == P.luhn(re.sub(r"\D", "", old))
            if k == "ip":
                assert P._private([*map(int, got.split("."))]) == P._private([*map(int, old.split("."))])
            if k.startswith("given"):
                assert P.gender_of(got.split("-")[0]) == k[-1]
            if k in ("family",) or k.startswith("given"):
                assert P.script_of(got) == P.script_of(old)


@pytest.mark.parametrize("max_sent", [100_000, 0])
def test_corpus(spark, max_sent):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS], "doc_id bigint, text string, n_private int, kind string")
    out = P.anonymise(df, "key", max_sent=max_sent).collect()
    assert len(out) == len(ROWS) and out[0].__fields__[:4] == ["doc_id", "text", "n_private", "kind"]
    by = {r.doc_id: r for r in out}
    assert by[4].text is None and by[5].text == "" and by[7].text == ROWS[8][1] and by[7]["_n_private"] == 0
    values = {(k, v): set() for _, t in ROWS for _, _, k, v in P.find(t or "")}
    for (_, old), row in ((r, o) for r in ROWS for o in out if o.doc_id == r[0]):
        for (_, _, k, v), (_, _, k2, v2) in zip(P.find(old or ""), P.find(row.text or ""), strict=True):
            values[(k, v)].add(v2)
            assert k == k2
    assert all(len(x) == 1 for x in values.values())                                   # one surrogate for each entity
    per_kind = {}
    for (k, v), x in values.items():
        per_kind.setdefault(k, []).append(next(iter(x)))
        assert (k, next(iter(x))) not in values                                        # none is a real value
    assert all(len(x) == len(set(x)) for x in per_kind.values())


def test_collisions_are_drawn_again(spark):
    """More family names than single names to draw from."""
    names = [f"Q{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(120)]
    df = spark.createDataFrame([(i, f"Mr {n}") for i, n in enumerate(names)] + [(500, "Mr Adler and Mr Weaver")], "doc_id bigint, text string")
    first = P.anonymise(df, "key")
    second = P.anonymise(df, "key", max_sent=0)
    got = {r.doc_id: r.text for r in first.collect()}
    assert got == {r.doc_id: r.text for r in second.collect()}
    assert len({got[i] for i in range(len(names))}) == len(names)
    assert not {"Mr Adler", "Mr Weaver"} & set(got.values())
    assert P.anonymise(df.limit(0), "key").count() == 0
    assert got != {r.doc_id: r.text for r in P.anonymise(df, "other").collect()}


def test_whole_table(spark):
    from anthro.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r.text for r in QUERIES["op2_pii_surrogates"](spark, sf).collect()}
    old = {(k, v) for t in docs.values() for _, _, k, v in P.find(t)}
    new = {(k, v) for t in out.values() for _, _, k, v in P.find(t)}
    assert old and len(old) == len(new) and not old & new
    plain = re.compile(r"@|\d{13,}|token = \"")
    assert all(t == out[d] for d, t in docs.items() if not P.find(t))
    for d, t in docs.items():
        if plain.search(t):
            assert out[d] != t
