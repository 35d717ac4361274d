import re

import pytest

from anthro.llm import licenses as L


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(L.ordinary_paragraphs(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def brute(docs, m):
    out = []
    for d, t in docs:
        for k, paragraph in enumerate(re.split(r"\n(?:[ \t\x0B\f\r]*\n)+", t) if t is not None else []):
            lines = paragraph.split("\n")
            units = []
            for u, text in enumerate([paragraph, *(lines if len(lines) > 1 else [])]):
                feats = L.features_of(text)
                if not any(f in m.rows for f in feats):
                    continue
                fam, p, o = m.family(feats)
                if fam != L.NONE:
                    q, _ = m.scores(feats)
                    best = max(range(len(q) - 1), key=lambda i: (q[i], m.classes[i]))
                    units.append((u, fam, p, m.classes[best], o))
            whole = max((o for u, fam, _, _, o in units if u == 0 and fam != L.UNKNOWN), default=0.0)
            named = [x for x in units if x[1] != L.UNKNOWN and x[4] >= whole - 1e-12]
            chosen = {}
            for x in sorted(named, key=lambda x: (-round(x[4], 9), x[0])):
                chosen.setdefault(x[1], x)
            if not named and units:
                chosen[L.UNKNOWN] = min(units, key=lambda x: (-round(x[2], 9), x[0]))
            for fam, (u, _, p, best, o) in chosen.items():
                out.append((d, k, u or None, fam, round(p, 6), best, round(o, 6), fam != L.UNKNOWN))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.paragraph, r.line, r.family, round(r.probability, 6), r.predicted, round(r.overlap, 6), r.confirmed) for r in df.collect()), key=str)


def test_templates_are_found(model):
    for fam, texts in L.TEMPLATES.items():
        for t in texts:
            p, over = model.scores(L.features_of(t))
            assert model.classes[int(p.argmax())] == fam, t
    for t in ("Licensed under the Frobnitz Public Agreement, version 9.", "The license terms are given by the vendor."):
        p, _ = model.scores(L.features_of(t))
        assert p[-1] < 0.5
    assert model.scores(L.features_of("The cat sat on the mat and looked at the moon."))[0][-1] > 0.9


def test_scan_matches_brute_force(spark, model):
    docs = [(1, "Intro line here.\nLicensed under the Apache License, Version 2.0.\nend"), (2, None), (3, ""), (None, "Released under the MIT License."),
            (4, "Copyright (c) 2019 Jane Doe. All rights reserved."), (4, "Copyright (c) 2019 Jane Doe. All rights reserved."), (5, "word " * 30000 + "Released under the ISC License."),
            (6, "This work is licensed under the GNU General Public License, version 3."), (7, "licensed under the GNU Affero General Public License, version 3"),
            (8, "See the license for details.\n\n\nLicensed under the Example license"), (9, "the version of the license we released")]
    df = spark.createDataFrame([(d, t, "q", 1) for d, t in docs], "doc_id bigint, text string, family string, feature int")
    got = rows(L.scan(df, model))
    assert got == brute(docs, model)
    fam = {(r[0], r[1]): r[3] for r in got}
    assert fam[(1, 0)] == "Apache-2.0" and fam[(None, 0)] == "MIT" and fam[(6, 0)] == "GPL-3.0" and fam[(7, 0)] == "AGPL-3.0"
    assert L.scan(df.limit(0), model).count() == 0


def test_whole_table(spark):
    from anthro.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    m = L.fit(L.ordinary_paragraphs(df))
    got = rows(QUERIES["op1_license_scan"](spark, sf))
    assert got == brute(docs, m)
    notices = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
               "Released under the MIT License.": "MIT"}
    want = {(d, notices[line]) for d, t in docs for line in t.split("\n") if line in notices}
    found = {(r[0], r[3]) for r in got if r[7]}
    assert want and want <= found
    texts = dict(docs)
    assert all(any(x in texts[d] for x in ("icense", "rights reserved")) for d, _ in found)


def test_no_corpus(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.license_scan(df).count() == 0


def wrap(text, width, lead):
    import textwrap

    return "\n".join(lead + x for x in textwrap.wrap(text, width))


GPL = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
       "Foundation{1} either version {2} of the License, or (at your option) any later version.")
MIT = L.TEMPLATES["MIT"][-1] + ", subject to the following conditions:"
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:")


@pytest.mark.parametrize("width", [40, 60, 78, 200])
@pytest.mark.parametrize("lead", ["", " * ", "# "])
def test_wrapped_notices(spark, model, width, lead):
    texts = {"GPL-2.0": GPL.format(";", ";", 2), "GPL-3.0": GPL.format(":", ",", 3), "MIT": MIT, "BSD": BSD}
    docs = [(i, f"Copyright (c) 2020 Jane Doe\n\n{wrap(t, width, lead)}\n\nint main() {{ return 0; }}") for i, t in enumerate(texts.values())]
    got = rows(L.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), model))
    for i, fam in enumerate(texts):
        assert {r[3] for r in got if r[0] == i and r[7] and r[1] == 1} == {fam}


#: Notices of licences of which nothing is trained or calibrated on.
FOREIGN = ["SPDX-License-Identifier: LPPL-1.3c", "This work may be distributed and/or modified under the conditions of the LaTeX Project Public License, version 1.3.",
           "Licensed under the Academic Free License version 3.0", "Released under the Ruby License.", "SPDX-License-Identifier: Python-2.0", "SPDX-License-Identifier: QPL-1.0",
           "This library is distributed under the terms of the Q Public License.", "Licensed under the Open Software License version 3.0",
           "The contents of this file are subject to the Netscape Public License Version 1.1.", "Licensed under the Reciprocal Public License 1.5",
           "SPDX-License-Identifier: NCSA", "This file is part of the NASA software and released under the NASA Open Source Agreement.",
           "Use of this file is subject to the Sun Industry Standards Source License.", "Released under the Upstream Compatibility License v1.0", "Licensed under the Vovida Software License.",
           "Covered by the IBM Public License 1.0", "SPDX-License-Identifier: EPL-2.0", "All rights to the name Zlib are reserved by the project."]


def test_licences_never_trained_on_are_unknown(model):
    found = [model.family(L.features_of(t))[0] for t in FOREIGN]
    wrong = [x for x in zip(FOREIGN, found, strict=True) if x[1] not in (L.UNKNOWN, L.NONE)]
    assert len(wrong) <= 1, wrong
    for t in ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"):
        assert model.family(L.features_of(t))[0] == L.UNKNOWN


def test_two_notices_in_one_paragraph(spark, model):
    text = "Some words before it.\nReleased under the MIT License.\nAnd in between others.\nLicensed under the Apache License, Version 2.0.\nthe end"
    got = rows(L.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model))
    assert {(r[3], r[2]) for r in got} == {("MIT", 2), ("Apache-2.0", 4)}


def test_sample_is_bounded(spark):
    df = spark.createDataFrame([(i, f"line number {i} is here\nthe same line in every text") for i in range(3000)], "doc_id bigint, text string")
    got = L.ordinary_paragraphs(df, size=50)
    assert 25 <= len(got) == len(set(got)) <= 50
