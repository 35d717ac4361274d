"""Toxicity as an ordered grade, by cumulative-link regression on sparse text features.

P(grade > k | x) = sigmoid(w.x - theta_k), with one weight vector for all
thresholds theta_0 <= theta_1 <= ...; the expected grade is the sum of these
probabilities.  Features are a text's distinct words and word beginnings (4 to
8 bytes), as 64-bit hashes: invented or inflected forms share beginnings.

Training uses at most about ``max_docs`` labelled texts (chosen by a hash of the
id, one share for each grade), each with the weight 1 / share, so that base rate,
severity and verdicts are those of all labelled texts.  Features are counted for each grade by Spark;
the ``max_features`` most telling ones are kept, so that the design matrix, the
fit and the model sent to the workers are bounded.

``grades_from_labels`` makes grades from a 0/1 label: 0 is clean; toxic texts
are 1, or 2 when they hold at least ``severe`` occurrences of telling words,
words that only toxic texts of the training rows have.

Defined results: null or empty text has no features and gets the base rate;
null ids are never trained on; repeated rows count each; labels that are null
or have no text are ignored; with no labels, or labels of one grade, every
expected grade is that grade (0 without labels); extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, row_ranges, stage
from anthro.llm.textnum import Words, byte_table, distinct_per_row, mix

MAX_DOCS = 12_000
MAX_FEATURES = 6_000
LEAST_TEXTS = 4           # training texts that a feature must be in
LEAST_Z = 2.5             # log-odds statistic that it must reach
SEVERE = 3
RIDGE = 0.003
STEPS = 300
REJECT = 0.35             # P(grade > 0) from which a text counts as toxic
BEGINNINGS = (4, 5, 6, 7, 8)
LETTERS = byte_table({b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)})


def feature_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of every word and word beginning, repeats included."""
    w = Words(texts, LETTERS)
    raw = np.frombuffer(w.data, np.uint8)
    size, doc = w.end - w.start, w.doc
    out, rows = [w.hash], [doc]
    begin = np.zeros(len(size), np.uint64)
    for k in range(max(BEGINNINGS)):
        long = size > k
        begin[long] = begin[long] * np.uint64(1_000_003) + raw[w.start[long] + k]
        if k + 1 in BEGINNINGS:
            longer = size > k + 1
            out.append(mix(begin[longer] * np.uint64(8) + np.uint64(k + 1)))
            rows.append(doc[longer])
    return np.concatenate(out), np.concatenate(rows)


@dataclass
class Model:
    features: np.ndarray      # sorted
    weights: np.ndarray
    thresholds: np.ndarray    # rising; one less than grades

    def exceed(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        n = len(texts)
        score = np.zeros(n)
        if len(self.features):
            f, r = distinct_per_row(*feature_stream(texts))
            at = np.minimum(np.searchsorted(self.features, f), len(self.features) - 1)
            hit = self.features[at] == f
            score = np.bincount(r[hit], self.weights[at[hit]], n)
        return sigmoid(score[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, n_features: int, n_grades: int,
                ridge: float = RIDGE, steps: int = STEPS, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds from a 0/1 design given by its entries, by Adam on the likelihood; ``weight``: how many texts a row stands for."""
    n = len(grade)
    part = np.full(n, 1 / max(n, 1)) if weight is None else weight / weight.sum()
    w = np.zeros(n_features)
    share = np.array([np.clip(part[grade > k].sum(), 1e-3, 1 - 1e-3) for k in range(n_grades - 1)])
    theta = -np.log(share / (1 - share))
    theta = np.maximum.accumulate(theta + 1e-3 * np.arange(len(theta)))
    p = np.concatenate([w, [theta[0]], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    k_top, k_low = np.minimum(grade, n_grades - 2), np.maximum(grade - 1, 0)
    for step in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1:])
        theta = p[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, w[cols], n)
        above = np.where(grade < n_grades - 1, sigmoid(score - theta[k_top]), 0.0)     # P(grade > own)
        at_least = np.where(grade > 0, sigmoid(score - theta[k_low]), 1.0)              # P(grade >= own)
        own = np.maximum(at_least - above, 1e-9)
        d_low, d_top = at_least * (1 - at_least) / own, above * (1 - above) / own
        d_score = (d_low - d_top) * part
        d_theta = np.zeros(n_grades - 1)
        np.add.at(d_theta, k_low[grade > 0], -(d_low * part)[grade > 0])
        np.add.at(d_theta, k_top[grade < n_grades - 1], (d_top * part)[grade < n_grades - 1])
        tail = np.cumsum(d_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, d_score[rows], n_features) - ridge * w / max(1, np.sqrt(n_features)), [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        p = p + 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    theta = p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])
    return p[:n_features], theta


# ---------------------------------------------------------------- training

def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_docs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, grade, weight) of a bounded share of the labelled texts, stored; weight: 1 / the grade's share."""
    lab = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("grade")).where("id is not null and grade is not null")
    lab = lab.groupBy("id").agg(F.max("grade").alias("grade"))
    per_grade = {r.grade: r.n for r in lab.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if not per_grade:
        return stage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(0).alias("grade"), F.lit(1.0).alias("weight")).limit(0), "training")
    room = max_docs / len(per_grade)
    millionths = F.coalesce(*[F.when(F.col("grade") == g, F.lit(math.ceil(min(1.0, room / n) * 1_000_000))) for g, n in per_grade.items()])
    chosen = lab.where(F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1_000_000)) < millionths).withColumn("weight", F.lit(1e6) / millionths)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return stage(texts.join(F.broadcast(chosen), "id"), "training")  # about max_docs labels


def _counted(rows: DataFrame) -> DataFrame:
    """(feature, grade, n): texts of each grade that have a feature."""
    out = "feature bigint, grade int, n bigint"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_ranges(batches, "text"):
            f, r = distinct_per_row(*feature_stream(column(b, "text")))
            g = np.asarray(column(b, "grade"))[r]
            for grade in np.unique(g):
                feature, n = np.unique(f[g == grade], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(np.full(len(n), grade, np.int32)), pa.array(n)], schema=arrow)

    return rows.select("text", "grade").mapInArrow(run, out).groupBy("feature", "grade").agg(F.sum("n").alias("n"))


def telling_features(rows: DataFrame, max_features: int, only: bool = False) -> np.ndarray:
    """The features with the largest log-odds statistic between grade 0 and above, sorted by hash."""
    totals = {r.up: r.n for r in rows.groupBy((F.col("grade") > 0).alias("up")).agg(F.count("*").alias("n")).collect()}
    up, low = totals.get(True, 0), totals.get(False, 0)
    c = _counted(rows).groupBy("feature").agg(F.sum(F.when(F.col("grade") > 0, F.col("n")).otherwise(0)).alias("a"),
                                              F.sum(F.when(F.col("grade") > 0, 0).otherwise(F.col("n"))).alias("b"))
    c = c.where(f"a + b >= {LEAST_TEXTS}")
    odds = F.log((F.col("a") + 0.5) / (F.lit(up + 0.5) - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (F.lit(low + 0.5) - F.col("b") + 0.5))
    weight = F.abs(odds) / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    c = c.where(weight >= LEAST_Z)
    if only:
        c = c.where("b = 0")
    top = c.orderBy(F.desc(weight), "feature").limit(max_features).select("feature").toArrow()
    return np.sort(np.asarray(top["feature"]).view(np.uint64))


def grades_from_labels(rows: DataFrame, severe: int = SEVERE) -> DataFrame:
    """``rows`` with grade 1 raised to 2 where telling words occur ``severe`` times or more; stored."""
    marks = telling_features(rows, 200, only=True)
    out = "id bigint, text string, grade int, weight double"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_ranges(batches, "text"):
            f, r = feature_stream(column(b, "text"))
            grade = np.asarray(column(b, "grade")).copy()
            if len(marks):
                at = np.minimum(np.searchsorted(marks, f), len(marks) - 1)
                many = np.bincount(r[marks[at] == f], minlength=b.num_rows)
                grade[(grade > 0) & (many >= severe)] = 2
            yield pa.RecordBatch.from_arrays([column(b, "id"), column(b, "text"), pa.array(grade.astype(np.int32)), column(b, "weight")], schema=arrow)

    return stage(rows.select("id", "text", "grade", "weight").mapInArrow(run, out), "graded")


def train(rows: DataFrame, max_features: int = MAX_FEATURES) -> Model:
    """Fit on (text, grade, weight) rows; grades from 0."""
    n_grades = 1 + (rows.agg(F.max("grade")).first()[0] or 0)
    if n_grades == 1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    features = telling_features(rows, max_features)
    out = "grade int, weight double, cols array<int>"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_ranges(batches, "text"):
            f, r = distinct_per_row(*feature_stream(column(b, "text")))
            at = np.minimum(np.searchsorted(features, f), len(features) - 1)
            hit = features[at] == f
            edges = np.searchsorted(r[hit], np.arange(b.num_rows + 1)).astype(np.int32)
            cols = pa.ListArray.from_arrays(edges, pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([column(b, "grade"), column(b, "weight"), cols], schema=arrow)

    design = rows.select("text", "grade", "weight").mapInArrow(run, out).toArrow() if len(features) else None  # max_docs rows of kept features
    if design is None:
        plain = rows.select("grade", "weight").collect()
        grade, weight = np.array([r.grade for r in plain]), np.array([r.weight for r in plain])
        where, cols = np.zeros(0, np.int64), np.zeros(0, np.int64)
    else:
        grade, weight = np.asarray(design["grade"]), np.asarray(design["weight"])
        lists = design["cols"].combine_chunks()
        cols = np.asarray(lists.flatten())
        where = np.repeat(np.arange(len(grade)), np.asarray(pa.compute.list_value_length(lists)))
    w, theta = fit_ordinal(where, cols, grade, len(features), n_grades, weight=weight)
    return Model(features, w, theta)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic): expected grade, P(grade > 0), likeliest grade, verdict."""
    out = "doc_id bigint, severity double, p_toxic double, grade int, toxic boolean"
    arrow = arrow_schema(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_ranges(batches, "text"):
            p = sent.value.exceed(column(b, "text"))
            full = np.concatenate([np.ones((b.num_rows, 1)), p, np.zeros((b.num_rows, 1))], axis=1)
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(p.sum(axis=1)), pa.array(full[:, 1]),
                                              pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32)),
                                              pa.array(full[:, 1] >= REJECT)], schema=arrow)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, out)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_docs: int = MAX_DOCS) -> Model:
    """The model from documents and their 0/1 labels, with grades 0, 1, 2."""
    return train(grades_from_labels(training_rows(docs, labels, label_col, max_docs)))


def keep_clean(docs: DataFrame, model: Model, most: float = REJECT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose P(grade > 0) is below ``most``; all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def p_toxic(texts):
        import pandas as pd

        from anthro.llm.textnum import slices

        t = pa.array(texts, pa.string(), from_pandas=True)
        parts = [sent.value.exceed(t.slice(lo, hi - lo)) for lo, hi in slices(t)]
        p = np.concatenate(parts) if parts else np.zeros((0, 1))
        return pd.Series(p[:, 0] if p.shape[1] else np.zeros(len(t)))

    return docs.where(p_toxic(F.col(text_col).cast("string")) < most)
