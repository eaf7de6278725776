"""Language identification by hierarchical discrimination: a linear model names the family, then one-versus-one linear
support vector machines tell the languages of that family apart.

Features are shares of hashed byte 1- to 4-grams of the lower-case text, runs of other bytes than letters taken as one.
Contract for odd inputs: a null text and a text without a letter are `und` with score 0; texts are read whole; repeated
rows get equal results; a language that is not in FAMILIES is a family of its own; with one learnt language it is
always named; without any, `und`; ties go to the language that comes first by code point; an empty table gives no
rows; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, chunks, fold_of, lean, mix64, table, text_bytes
from .linear import labelled_sample, learned, sigmoid

#: Documents of each language that are learnt from, at most; and the features' hash bits.
SAMPLE, BITS = 400, 13
GRAMS = (1, 2, 3, 4)
#: Families of language codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "sinitic": ("yue", "zh"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "baltic": ("lt", "lv"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return FAMILY.get(lang.lower().split("-")[0], f"only {lang}")


#: Bytes as the grams see them: lower case, bytes above 127 as they are, all others as one space.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(first row, row offsets into bytes, hashed gram that begins at each byte for each length, its row or -1)."""
    buf, offs = text_bytes(column)
    for a, b in chunks(offs):
        part, at = _SEEN[buf[offs[a] : offs[b]]], offs[a : b + 1] - offs[a]
        keep = np.ones(len(part), bool)
        keep[1:] = (part[1:] != 32) | (part[:-1] != 32)
        keep[at[:-1][at[:-1] < len(part)]] = True
        before = np.concatenate([[0], np.cumsum(keep)])
        part, at = part[keep].astype(np.uint64), before[at]
        row = np.repeat(np.arange(b - a), np.diff(at))
        out, gram = [], np.zeros(len(part), np.uint64)
        for k in range(max(GRAMS)):
            n = len(part) - k
            if n <= 0:
                break
            gram = (gram[:n] << np.uint64(8)) | part[k:]
            if k + 1 in GRAMS:
                out.append((mix64(gram + np.uint64((k + 1) << 40)) >> np.uint64(64 - BITS)).astype(np.int64))
        yield a, at, out, row


def gram_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For training: (first row, offsets, hashed grams that lie within their row)."""
    for a, at, by_length, row in grams(column):
        feats, owners = [], []
        for g, k in zip(by_length, GRAMS, strict=False):
            whole = row[: len(g)] == row[k - 1 :]
            feats.append(g[whole])
            owners.append(row[: len(g)][whole])
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        yield a, np.searchsorted(owner[order], np.arange(len(at))), (np.concatenate(feats) if feats else np.zeros(0, np.int64))[order]


@dataclass(frozen=True)
class Model:
    """One column of weights for each decision: the families first (one against the rest), then pairs of languages of
    one family."""

    weights: np.ndarray
    bias: np.ndarray
    families: list[str]
    languages: list[list[str]]
    pairs: list[tuple[int, int, int]]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        sums, counts = np.zeros((len(column), self.weights.shape[1])), np.zeros(len(column))
        for a, at, by_length, row in grams(column):
            n = len(at) - 1
            for g, k in zip(by_length, GRAMS, strict=False):
                whole = row[: len(g)] == row[k - 1 :]
                owner = row[: len(g)][whole]
                cells = self.weights[g[whole]]
                firsts = np.searchsorted(owner, np.arange(n))
                full = np.bincount(owner, minlength=n) > 0
                if len(cells):
                    sums[a : a + n][full] += np.add.reduceat(cells, firsts[full], axis=0, dtype=np.float64)
                counts[a : a + n] += np.bincount(owner, minlength=n)
        margin = sums / np.maximum(counts, 1)[:, None] + self.bias
        family = margin[:, : len(self.families)]
        best = family.argmax(axis=1) if len(self.families) > 1 else np.zeros(len(column), int)
        sure = sigmoid(2 * family.max(axis=1)) if len(self.families) > 1 else np.ones(len(column))
        names, scores = np.empty(len(column), object), sure.copy()
        for f, langs in enumerate(self.languages):
            rows = np.flatnonzero(best == f)
            wins, support = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            for k, (g, i, j) in enumerate(self.pairs):
                if g == f:
                    m = margin[rows, len(self.families) + k]
                    wins[:, i] += m >= 0
                    wins[:, j] += m < 0
                    support[:, i] += m
                    support[:, j] -= m
            rank = wins + np.tanh(support / max(1, len(langs))) * 0.49
            pick = rank.argmax(axis=1)
            names[rows] = np.array(langs, object)[pick]
            if len(langs) > 1:
                scores[rows] *= sigmoid(2 * support[np.arange(len(rows)), pick] / (len(langs) - 1))
        return names.tolist(), scores


def svm(x: np.ndarray, y: np.ndarray, passes: int = 12, cost: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged sub-gradient steps on the hinge loss; y is -1 or 1."""
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, t = np.zeros_like(w), 0.0, 0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    order = np.random.default_rng(11)
    for _ in range(passes):
        for part in np.array_split(order.permutation(len(y)), max(1, len(y) // 32)):
            t += 1
            off = y[part] * (x[part] @ w + b) < 1
            step = 20.0 / (1 + 0.02 * t)
            pull = (weight[part] * y[part] * off) / len(part)
            w = (1 - step * cost) * w + step * (pull @ x[part])
            b += 0.05 * step * pull.sum()
            mean_w += (w - mean_w) / t
            mean_b += (b - mean_b) / t
    return mean_w, mean_b


def train(features: list[np.ndarray], langs: np.ndarray) -> Model:
    size = 1 << BITS
    if not features:
        return Model(np.zeros((size, 0), np.float32), np.zeros(0), [], [], [])
    x = np.zeros((len(features), size), np.float32)
    for i, f in enumerate(features):
        if len(f):
            x[i] = np.bincount(f, minlength=size) / len(f)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)  # rare grams count as much as common ones
    x *= scale.astype(np.float32)
    known = sorted(set(langs.tolist()))
    families = sorted({family_of(k) for k in known})
    languages = [[k for k in known if family_of(k) == f] for f in families]
    kin = np.array([families.index(family_of(k)) for k in langs]) if len(langs) else np.zeros(0, int)
    columns = [svm(x, np.where(kin == f, 1.0, -1.0)) if len(families) > 1 else (np.zeros(size), 0.0) for f in range(len(families))]
    pairs = [(f, i, j) for f, own in enumerate(languages) for i in range(len(own)) for j in range(i + 1, len(own))]
    for f, i, j in pairs:
        two = np.flatnonzero((langs == languages[f][i]) | (langs == languages[f][j]))
        columns.append(svm(x[two], np.where(langs[two] == languages[f][i], 1.0, -1.0)))
    weights = np.stack([w * scale for w, _ in columns], axis=1) if columns else np.zeros((size, 0))
    return Model(weights.astype(np.float32), np.array([b for _, b in columns]), families, languages, pairs)


def fit(docs: DataFrame, most: int = SAMPLE) -> Model:
    """Learns from the text and lang of at most `most` documents of each language."""
    return learned(labelled_sample(docs, docs, "lang", most), gram_features, train)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                text = batch.column(2).fill_null("")
                letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
                names, scores = sent.value.predict(text) if sent.value.families else (["und"] * batch.num_rows, np.zeros(batch.num_rows))
                names = [x if ok else "und" for x, ok in zip(names, letters, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.where(letters, scores, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    arrow_rows(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), F.col("text")).mapInArrow(lean(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, fit(docs.where((fold_of("doc_id", 4) != 2) & F.col("lang").isNotNull())))
