"""A quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates, scores as
sparse dot products.

Contract for odd inputs: null and empty texts have no feature and the score of the bias alone; texts are read whole;
repeated rows get equal scores; without labels, or with one label value only, every score is that value's prior (0.5
without any); an empty table gives no rows; extra columns are never read, labels are looked up by doc_id only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, fold_of, lean, table
from .linear import ftrl, labelled_sample, learned, sigmoid, sums_by_row, word_features

#: Labelled rows of each label value that are learnt from, at most.
SAMPLE = 4000
BITS, NGRAM, PASSES = 18, 2, 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for a, offs, f in word_features(column, BITS, NGRAM):
            n = np.maximum(np.diff(offs), 1)
            out[a : a + len(n)] = sigmoid(self.bias + sums_by_row(self.weights[f], offs) / np.sqrt(n))
        return out


def train(features: list[np.ndarray], labels: np.ndarray) -> Model:
    """Follow-the-regularised-leader over counts that are scaled by the root of their sum."""
    size = 1 << BITS
    labels = labels.astype(np.float64)
    if not len(labels) or labels.min() == labels.max():
        bias = float(np.log((labels.mean() + 0.01) / (1.01 - labels.mean()))) if len(labels) else 0.0
        return Model(np.zeros(size, np.float32), bias)
    costs = np.where(labels > 0, 1.0, max(0.2, labels.mean() / (1 - labels.mean())))
    rows = []
    for f in features:
        at, counts = np.unique(f, return_counts=True)
        rows.append((np.append(at, size), np.append(counts / np.sqrt(max(1, len(f))), 1.0)))
    w = ftrl(rows, labels, size + 1, PASSES, costs)
    return Model(w[:size].astype(np.float32), float(w[size]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    return learned(labelled_sample(docs, labels, label, most), lambda column: word_features(column, BITS, NGRAM), train)


def scored(docs: DataFrame, model: Model, columns: list[str], folds: int, held: int) -> DataFrame:
    """The named columns of docs, held_out, score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = sent.value.scores(batch.column(batch.num_columns - 1))
                names = [batch.schema.field(i).name for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"])

    arrow_rows(docs.sparkSession)
    rows = docs.select(*columns, (fold_of("doc_id", folds) == held).alias("held_out"), F.col("text").alias("scored_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(lean(run), f"{kinds}, score double, predicted int")


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    """Learnt from the labelled rows that are not held out."""
    learnt = table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0)
    return fit(table(spark, sf_dir, "documents"), learnt)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), model_for(spark, sf_dir), ["doc_id"], 5, 0)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all columns, that the model doesn't reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(sent.value.scores(batch.column(at)) >= THRESHOLD))

    arrow_rows(docs.sparkSession)
    return docs.mapInArrow(lean(run), docs.schema)
