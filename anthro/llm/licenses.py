"""Licence scan: a trained paragraph classifier confirmed by template comparison.

A paragraph is a run of lines without a blank one between; its lines are read as
one, so a notice wrapped over several lines is whole.  Its features are its
distinct words and word pairs.  A multinomial logistic regression over licence
families, "unknown" (licence wording of no listed family) and "none" is trained on
written variants of the templates below, on notices of other licences and general
wording, and on a bounded sample of the corpus's own paragraphs; features common
in ordinary paragraphs are left out.  Temperature and the least probability of a
family are fitted on variants held out and on licences of which no text was trained.

Scanning uses DataFrame operations only: features are exploded and joined with
the small weight table (its size is bounded by the templates), sums by
paragraph give the log-odds of each class and the overlap with each template, in
which a feature counts the more the fewer notices have it.  Where a paragraph has
licence wording its lines are scored alone too, as a notice may stand in a line
between others.  A family stands when its calibrated probability reaches the
model's least, the best template of that family covers at least ``least_overlap``
of its own features, and no template of another family covers as much of its own;
of a paragraph and its lines, each family is named once, at its best overlap.
Where none stands the paragraph is "unknown".

Defined results: null and empty texts have no paragraphs; paragraphs without
licence wording give no row; null ids and repeated rows are kept (each gives its
rows); ties of classes go to the later name, of units to the whole paragraph,
then the first line; very long paragraphs are read whole; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 2_000
SAMPLE_CHARS = 4_000
COMMON = 0.02             # share of ordinary paragraphs above which a feature is left out
LEAST_P = 0.6             # of a family, where calibration asks for no more
LEAST_OVERLAP = 0.7
MOST_FALSE = 0.01         # share of held-out other licences that may pass for a family
VARIANTS = 24
RIDGE = 1e-3
STEPS = 400
NONE, UNKNOWN = "none", "unknown"

# The notices by which licences are usually named.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
            "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            "of the Software, and to permit persons to whom the Software is furnished to do so"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                "Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                "Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Released under the BSD 3-Clause License.",
            "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Released under the Mozilla Public License, version 2.0."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "Released under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["Copyright. All rights reserved.", "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
# Notices of other licences, which belong to no family above.
OTHERS = {
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0.", "SPDX-License-Identifier: EPL-2.0"],
    "EUPL": ["Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission", "SPDX-License-Identifier: EUPL-1.2"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages",
             "Released under the zlib license."],
    "Artistic": ["This program is distributed under the Artistic License 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    "WTFPL": ["This work is free. You can redistribute it and modify it under the terms of the Do What You Want Public License, Version 2."],
    "CDDL": ["The contents of this file are subject to the terms of the Common Development and Distribution License, version 1.0.", "SPDX-License-Identifier: CDDL-1.0"],
    "OFL": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "ODbL": ["This database is made available under the Open Database License.", "Any rights in individual contents are licensed under the Database Contents License."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "PostgreSQL": ["Released under the PostgreSQL License.", "SPDX-License-Identifier: PostgreSQL"],
    "Ms-PL": ["This source is subject to the Microsoft Public License.", "SPDX-License-Identifier: MS-PL"],
    "CPAL": ["The contents of this file are subject to the Common Public Attribution License Version 1.0."],
}
HELD_OUT = ("EUPL", "WTFPL", "OFL", "PostgreSQL")  # calibrated on, never trained
GENERAL = ["This software is licensed under the terms of the vendor agreement.", "See the license for details.", "The license of this work is described elsewhere.",
           "Released under a license to be chosen by the author.", "Licensed under the Example Public License, version 7.", "You may use this file under the license terms.",
           "License information is given in the notice file.", "This work is licensed to the customer only.", "Distributed under the terms of its license.",
           "All rights to the name are reserved by the project.", "License: see file COPYING.", "SPDX-License-Identifier: LicenseRef-Internal"]


def words_of(text: str) -> list[str]:
    out, word = [], []
    for c in text.lower():
        if "a" <= c <= "z" or "0" <= c <= "9":
            word.append(c)
        elif word:
            out.append("".join(word))
            word = []
    return [*out, "".join(word)] if word else out


def features_of(text: str) -> set[str]:
    w = words_of(text)
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))}


@dataclass
class Model:
    classes: list[str]
    templates: list[tuple[str, float]]   # family, weight of its kept features
    rows: dict[str, tuple[np.ndarray, np.ndarray]]   # feature: class weights, its weight in each template
    bias: np.ndarray
    temperature: float
    least_p: float

    def scores(self, feats: set[str]) -> tuple[np.ndarray, np.ndarray]:
        """Class probabilities, and the share of each template's features that are there."""
        hit = [self.rows[f] for f in feats if f in self.rows]
        z = (self.bias + sum((w for w, _ in hit), np.zeros(len(self.classes)))) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum(), sum((t for _, t in hit), np.zeros(len(self.templates))) / np.array([n or 1.0 for _, n in self.templates])

    def family(self, feats: set[str], least_overlap: float = LEAST_OVERLAP) -> tuple[str, float, float]:
        """Family that stands (or "unknown", or "none"), its probability and overlap."""
        p, over = self.scores(feats)
        if p[-1] >= 0.5:
            return NONE, float(p[-1]), 0.0
        best = max(range(len(p) - 1), key=lambda i: (p[i], self.classes[i]))
        mine = max((o for o, (fam, _) in zip(over, self.templates, strict=True) if fam == self.classes[best]), default=0.0)
        other = max((o for o, (fam, _) in zip(over, self.templates, strict=True) if fam != self.classes[best]), default=0.0)
        ok = self.classes[best] != UNKNOWN and p[best] >= self.least_p and mine >= least_overlap and mine > other
        return self.classes[best] if ok else UNKNOWN, float(p[best]), float(mine)


# ---------------------------------------------------------------- training

def _variant(rng: random.Random, text: str, filler: list[str]) -> str:
    w = [x for x in words_of(text) if rng.random() > 0.06]
    extra = [rng.choice(filler) for _ in range(rng.choice([0, 0, 0, 2, 5, 12]))]
    at = rng.randrange(len(extra) + 1)
    return " ".join(extra[:at] + w + extra[at:])


def fit(ordinary: list[str], seed: int = 11) -> Model:
    """Train on variants of the templates, general wording and ordinary paragraphs."""
    rng = random.Random(seed)
    per_feature: dict[str, int] = {}
    plain = [features_of(t) for t in ordinary]
    listed = [(fam, features_of(t)) for fam, texts in TEMPLATES.items() for t in texts]
    plain = [p for p in plain if not any(len(p & t) > 0.5 * len(t) for _, t in listed)]
    for p in plain:
        for f in p:
            per_feature[f] = per_feature.get(f, 0) + 1
    common = {f for f, n in per_feature.items() if n > max(2, COMMON * len(plain))}
    filler = sorted({w for p in plain for w in p if " " not in w})[:5000] or ["text", "page", "note"]
    known = [t for name, texts in OTHERS.items() if name not in HELD_OUT for t in texts]
    vocabulary = sorted({f for _, t in listed for f in t}.union(*(features_of(g) for g in [*GENERAL, *known])) - common)
    place = {f: i for i, f in enumerate(vocabulary)}
    classes = [*TEMPLATES, UNKNOWN, NONE]
    data: list[tuple[set[str], int, bool]] = []
    for c, name in enumerate(classes):
        texts = TEMPLATES.get(name, [*GENERAL, *known] if name == UNKNOWN else [])
        for t in texts:
            for k in range(VARIANTS):
                data.append((features_of(_variant(rng, t, filler) if k else t), c, k % 4 == 3))
    unseen = [t for name in HELD_OUT for t in OTHERS[name]]
    data += [(features_of(_variant(rng, t, filler) if k else t), len(classes) - 2, True) for t in unseen for k in range(VARIANTS)]
    for k, p in enumerate(plain):
        data.append((p, len(classes) - 1, k % 4 == 3))
    for k in range(200):
        data.append((features_of(" ".join(rng.choice(filler) for _ in range(12))), len(classes) - 1, k % 4 == 3))
    x = np.zeros((len(data), len(vocabulary)), np.float32)
    for i, (feats, _, _) in enumerate(data):
        x[i, [place[f] for f in feats if f in place]] = 1
    y, late = np.array([d[1] for d in data]), np.array([d[2] for d in data])
    share = 1 / np.bincount(y, minlength=len(classes))[y]
    w, b = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    m = [np.zeros_like(w), np.zeros_like(b)]
    v = [np.zeros_like(w), np.zeros_like(b)]
    tx, ty = x[~late], y[~late]
    ts = (share[~late] / share[~late].sum())[:, None]
    hot = np.eye(len(classes))[ty]
    for step in range(1, STEPS + 1):
        z = tx @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = ts * (p / p.sum(axis=1, keepdims=True) - hot)
        for i, (par, g) in enumerate(((w, tx.T @ d + RIDGE * w / len(classes)), (b, d.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            par -= 0.05 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    z, hs = x[late] @ w + b, share[late]

    def loss(t: float) -> float:
        q = z / t - (z / t).max(axis=1, keepdims=True)
        return float((hs * (np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(q)), y[late]])).sum())

    temperature = min((0.25 * 1.15 ** k for k in range(30)), key=loss)
    # a word that many notices have says little of which one it is
    notices = [t for _, t in listed] + [features_of(t) for t in [*GENERAL, *known]]
    rare = {f: float(np.log((1 + len(notices)) / sum(f in t for t in notices))) for f in place}
    kept = [(fam, t & place.keys()) for fam, t in listed]
    rows = {f: (w[i], np.array([rare[f] if f in t else 0.0 for _, t in kept])) for f, i in place.items()}
    model = Model(classes, [(fam, sum(rare[f] for f in sorted(t))) for fam, t in kept], rows, b, temperature, LEAST_P)
    return replace(model, least_p=_least_p(model, [features_of(_variant(rng, t, filler) if k else t) for t in unseen for k in range(VARIANTS)]))


def _least_p(model: Model, unseen: list[set[str]]) -> float:
    """The least probability, from ``LEAST_P`` on, at which no more than ``MOST_FALSE`` of the unseen licences pass for a family."""
    passing = sorted(p for fam, p, _ in map(model.family, unseen) if fam not in (NONE, UNKNOWN))
    spare = int(MOST_FALSE * len(unseen))
    return min(0.999, max(LEAST_P, passing[-spare - 1] + 1e-6)) if len(passing) > spare else LEAST_P


def paragraphs(text: Column) -> Column:
    """Runs of lines without a blank line between."""
    return F.split(text, r"\n(?:[ \t\x0B\f\r]*\n)+")


def ordinary_paragraphs(docs: DataFrame, text_col: str = "text", size: int = SAMPLE) -> list[str]:
    """At most ``size`` distinct lines of 20 to ``SAMPLE_CHARS`` characters, chosen by hash over the whole corpus.

    A threshold on the hash leaves about twice as many before they are ordered, so tasks send no more than that.
    """
    lines = docs.select(F.explode(F.split(F.col(text_col).cast("string"), r"\n")).alias("line")).where(F.length("line").between(20, SAMPLE_CHARS))
    n = lines.count()
    share = min(1.0, 2 * size / n) if n else 1.0
    few = lines.withColumn("h", F.xxhash64("line")).where(F.col("h") <= F.lit(min(2 ** 63 - 1, int(-2 ** 63 + share * 2 ** 64)))).distinct()
    return [r.line for r in few.orderBy("h", "line").limit(size).collect()]


# ---------------------------------------------------------------- scan

def feature_hashes(line: Column) -> Column:
    """64-bit hashes of a paragraph's distinct words and word pairs."""
    words = F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")

    def hashes(ws: Column) -> Column:  # single words, and each word with the one after it
        return F.array_distinct(F.concat(F.transform(ws, lambda w: F.xxhash64(w)),
                                         F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))))

    return F.get(F.transform(F.array(words), hashes), F.lit(0))  # the words are bound once


def weight_table(docs: DataFrame, model: Model) -> DataFrame:
    """feature hash, class weights and template membership: as many rows as the templates have features."""
    spark = docs.sparkSession
    n, t = len(model.classes), len(model.templates)
    schema = "a string, b string, " + ", ".join([f"w{i} double" for i in range(n)] + [f"t{i} double" for i in range(t)])
    rows = []
    for f, (w, member) in model.rows.items():
        a, _, b = f.partition(" ")
        rows.append((a, b or None, *map(float, w), *map(float, member)))
    table = spark.createDataFrame(rows, schema)
    return table.withColumn("feature", F.xxhash64("a", "b")).drop("a", "b")


def units(text: Column) -> Column:
    """Arrays of texts to score, one for each paragraph: the paragraph and, where it has several, its lines."""
    def of(paragraph: Column) -> Column:
        lines = F.split(paragraph, r"\n")
        return F.concat(F.array(paragraph), F.when(F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>")))

    return F.transform(paragraphs(text), of)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least_overlap: float = LEAST_OVERLAP) -> DataFrame:
    """One row per family that stands in a paragraph, or per paragraph with licence wording but of none: doc_id, paragraph,
    line (null: the paragraph as a whole), family, probability, predicted, overlap, confirmed."""
    n = len(model.classes)
    each = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                        F.posexplode(units(F.col(text_col).cast("string"))).alias("paragraph", "_units"))
            .select("doc_id", "_row", "paragraph", F.posexplode("_units").alias("_unit", "_text"))
            .select("doc_id", "_row", "paragraph", "_unit", F.explode(feature_hashes(F.col("_text"))).alias("feature")))
    sums = (each.join(F.broadcast(weight_table(docs, model)), "feature").groupBy("_row", "paragraph", "_unit")
            .agg(F.max("doc_id").alias("doc_id"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(n)], *[F.sum(f"t{i}").alias(f"t{i}") for i in range(len(model.templates))]))
    odds = F.array(*[(F.col(f"w{i}") + F.lit(float(model.bias[i]))) / F.lit(model.temperature) for i in range(n)])
    key = ["doc_id", "_row", "paragraph", "_unit"]
    out = sums.select(*key, odds.alias("_z"), *[(F.col(f"t{i}") / F.lit(float(k or 1.0))).alias(f"t{i}") for i, (_, k) in enumerate(model.templates)])
    out = out.withColumn("_top", F.array_max("_z"))
    out = out.withColumn("_all", F.aggregate("_z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("_top"))))
    out = out.where(F.exp(F.element_at("_z", n) - F.col("_top")) / F.col("_all") < 0.5)
    # the best class but "none"
    named = F.array(*[F.struct((F.exp(F.get("_z", i) - F.col("_top")) / F.col("_all")).alias("p"), F.lit(c).alias("family")) for i, c in enumerate(model.classes[:-1])])
    out = out.withColumn("_best", F.array_max(named))

    def overlap(same: bool) -> Column:
        parts = [F.when((F.col("_best.family") == fam) == same, F.col(f"t{i}")).otherwise(F.lit(0.0)) for i, (fam, _) in enumerate(model.templates)]
        return F.array_max(F.array(F.lit(0.0), *parts))

    out = out.select(*key, F.col("_best.family").alias("predicted"), F.col("_best.p").alias("probability"), overlap(True).alias("overlap"), overlap(False).alias("_other"))
    out = out.withColumn("confirmed", (F.col("predicted") != UNKNOWN) & (F.col("probability") >= model.least_p) & (F.col("overlap") >= least_overlap)
                         & (F.col("overlap") > F.col("_other")))
    # a line counts where it says no less than the paragraph; a family once; without any, the likeliest unit
    around = Window.partitionBy("_row", "paragraph")
    whole = F.max(F.when((F.col("_unit") == 0) & F.col("confirmed"), F.col("overlap"))).over(around)
    out = out.withColumn("_named", F.col("confirmed") & (F.col("overlap") >= F.coalesce(whole, F.lit(0.0))))
    out = out.withColumns({"_any": F.max("_named").over(around),
                           "_rank": F.row_number().over(Window.partitionBy("_row", "paragraph", "_named", F.when(F.col("_named"), F.col("predicted")))
                                                        .orderBy(F.desc(F.when(F.col("_named"), F.col("overlap")).otherwise(F.col("probability"))), "_unit"))})
    out = out.where((F.col("_named") == F.col("_any")) & (F.col("_rank") == 1))
    return out.select("doc_id", F.col("paragraph").cast("int").alias("paragraph"), F.when(F.col("_unit") > 0, F.col("_unit")).cast("int").alias("line"),
                      F.when(F.col("_named"), F.col("predicted")).otherwise(UNKNOWN).alias("family"), "probability", "predicted", "overlap", F.col("_named").alias("confirmed"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on this corpus's ordinary lines and scan every paragraph."""
    return scan(docs, fit(ordinary_paragraphs(docs, text_col)), id_col, text_col)
