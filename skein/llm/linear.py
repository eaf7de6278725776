"""Hashed features and linear models that the classifiers share; models are small arrays, trained in one task on a
bounded, documented sample and sent to all others."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, chunks, lean, lower_ascii, mix64, text_bytes, token_hashes, token_spans


#: Bounds of a training sample: its rows, and the features of all of them.
MOST_ROWS, MOST_FEATURES = 100_000, 1 << 26
#: The feature of any word that comes twice in a row.
REPEAT = np.uint64(0xC2B2AE3D27D4EB4F)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def labelled_sample(docs: DataFrame, rows: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and label of about `most` rows of each label value, MOST_ROWS in all, at most: rows have doc_id and
    label. They are chosen by a digest of doc_id, so the choice is the same on every run; ids are chosen before texts are
    read. Of several labels of a doc_id the largest counts."""
    rows = rows.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    rank = F.xxhash64(F.lit("sample"), "doc_id").bitwiseAND(0x7FFFFFFF) / float(0x80000000)
    held = rows.groupBy("label").agg(F.count("*").alias("held"))
    chosen = rows.join(held, "label").where(rank * F.col("held") < most).select(F.col("doc_id").alias("id"), "label").limit(MOST_ROWS)
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "label")


def word_features(column: pa.Array, bits: int, n: int = 2, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, features): hashed words and word n-grams up to n of some rows of texts, in order of
    occurrence by kind. Words are runs of letters and digits or of signs."""
    buf, offs = text_bytes(column)
    for a, b in chunks(offs):
        part, at = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        part = lower_ascii(part) if lower else part
        starts, ends, row = token_spans(part, at, signs=True)
        words = token_hashes(part, starts, ends)
        feats, owners = [words], [row]
        with np.errstate(over="ignore"):
            gram = words
            same = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
            feats.append(np.full(int(same.sum()), REPEAT))
            owners.append(row[1:][same])
            for k in range(1, n):
                gram = mix64(gram[: max(0, len(words) - k)] * np.uint64(0x9E3779B97F4A7C15) + words[k:])
                whole = row[: len(gram)] == row[k:]
                feats.append(gram[whole])
                owners.append(row[: len(gram)][whole])
                gram = gram.copy()
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        f = (np.concatenate(feats) >> np.uint64(64 - bits)).astype(np.int64)[order]
        yield a, np.searchsorted(owner[order], np.arange(b - a + 1)), f


def sums_by_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offs[1:]] - total[offs[:-1]]


def learned(sample: DataFrame, make, train):
    """train(features of each row, labels) of a bounded sample (doc_id, text, label). Features are made where the texts
    are; one task of an executor gathers them in order of doc_id, MOST_FEATURES at most, and only its model comes to the
    driver."""

    def features(batches):
        for batch in batches:
            for a, offs, f in make(batch.column(1)):
                out = [f[offs[i] : offs[i + 1]].astype("<i4").tobytes() for i in range(len(offs) - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a : a + len(out)], pa.array(out, pa.binary()), batch.column(2)[a : a + len(out)]], names=["doc_id", "f", "y"])

    def fitted(batches):
        rows, labels, held = [], [], 0
        for batch in batches:
            for f, y in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                held += len(f.as_buffer()) // 4
                if held <= MOST_FEATURES:
                    rows.append(np.frombuffer(f.as_py(), "<i4"))
                    labels.append(y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows, np.array(labels)))], pa.binary())], names=["model"])

    arrow_rows(sample.sparkSession)
    kinds = [sample.schema[c].dataType.simpleString() for c in ("doc_id", "label")]
    made = sample.mapInArrow(lean(features), f"doc_id {kinds[0]}, f binary, y {kinds[1]}")
    found = made.repartition(1).sortWithinPartitions("doc_id", "f").mapInArrow(lean(fitted), "model binary").collect()
    return pickle.loads(found[0][0]) if found else train([], np.zeros(0))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, passes: int, costs: np.ndarray, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> np.ndarray:
    """Weights of a logistic regression by follow-the-regularised-leader updates, a row at a time: z and n are kept for
    each feature, and weights come from them when needed. rows: feature numbers and values; labels may be soft."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(z[at], n[at])
            g = (sigmoid(w @ x) - labels[i]) * costs[i] * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(z, n)
