"""Language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts in small letters, every other character as one space, give n-grams of 1 to 3 characters hashed to ``BUCKETS`` features with weight
``log(1 + count) * idf``, scaled to length 1. Document frequencies are counted over all training rows by Spark. Weights are learnt by
follow-the-regularised-leader with an elastic-net penalty on a bounded, hash-chosen sample of the training rows, equal for each language;
one in ``CALIBRATE`` of the sample is kept out to set the temperature. Prediction reads whole texts inside tasks.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm.text import once

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Rows that weights are learnt on, at most about; features of one row take 6 bytes for each n-gram in it.
SAMPLE_ROWS = 4000
CALIBRATE = 5
UNKNOWN = "und"


def letters() -> np.ndarray:
    return once("letters", lambda: np.array([chr(k).isalpha() for k in range(0x110000)]))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features in use and their counts; none for a text without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.where(is_letter, codes, 32).astype(np.uint64)
    keep = is_letter | np.concatenate([[False], is_letter[:-1]])
    keep[np.flatnonzero(is_letter)[-1] + 1 :] = False
    codes = np.concatenate([[np.uint64(32)], codes[keep], [np.uint64(32)]])
    counts = np.zeros(BUCKETS, np.int64)
    for order in ORDERS:
        if len(codes) >= order:
            h = np.full(len(codes) - order + 1, order, np.uint64)
            for k in range(order):
                h = h * np.uint64(0x100000001B3) + codes[k : k + len(h)]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((h >> np.uint64(64 - 15)).astype(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used, counts[used]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages
    bias: np.ndarray
    temperature: float

    def values(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf[used]
        return v / max(np.sqrt(v @ v), 1e-12)

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.values(used, counts) @ self.weights[used] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        used, counts = ngram_counts(text)
        if not len(used) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(used, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def document_frequencies(training: DataFrame) -> np.ndarray:
    """The number of texts with each feature, over all rows."""

    def run(batches):
        found = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found[ngram_counts(text.as_py() or "")[0]] += 1
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(found[used])], names=["feature", "df"])

    table = training.select("text").mapInArrow(run, "feature int, df bigint").groupBy("feature").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[table.column("feature").to_numpy()] = table.column("df").to_numpy()
    return out


def sample_features(training: DataFrame, counts: dict[str, int], rows: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Class, features and counts of a sample of about ``rows`` rows, as many of each language as far as there are.

    Rows are drawn by a hash of ``doc_id`` and text, so equal rows are drawn together; the driver gets ``2 * rows`` rows at most, however
    often a row repeats.
    """
    each = max(1, rows // max(1, len(counts)))
    names = sorted(counts)
    share = F.lit(0.0)
    for name in names:
        share = F.when(F.col("lang") == name, min(1.0, each / counts[name])).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("turn")
    chosen = training.where(draw < share).select("lang", "text", turn, (draw / share).alias("place"))

    def run(batches):
        for batch in batches:
            found = [ngram_counts(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([u.astype(np.uint16).tobytes() for u, _ in found], pa.binary()),
                    pa.array([c.astype(np.uint32).tobytes() for _, c in found], pa.binary()),
                    *batch.columns[2:],
                ],
                names=["lang", "used", "counts", "turn", "place"],
            )

    sampled = chosen.mapInArrow(run, "lang string, used binary, counts binary, turn bigint, place double")
    table = sampled.orderBy("place", "turn", "lang", "used").limit(2 * rows).toPandas()
    table = table.sort_values(["turn", "lang", "used"])
    out = []
    for lang, used, count in zip(table.lang, table.used, table.counts, strict=True):
        if len(used):
            out.append((names.index(lang), np.frombuffer(used, np.uint16).astype(np.int64), np.frombuffer(count, np.uint32)))
    return out


def follow_the_leader(
    rows, idf: np.ndarray, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, epochs: int = 3
) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights and biases by FTRL-Proximal, one row at a time."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(z, n):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for label, used, counts in rows:
            v = np.log1p(counts) * idf[used]
            v = np.append(v / max(np.sqrt(v @ v), 1e-12), 1.0)
            at = np.append(used, BUCKETS)
            w = weights(z[at], n[at])
            p = softmax(v @ w)
            p[label] -= 1
            g = np.outer(v, p)
            rise = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - rise * w
            n[at] += g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def temperature(model: LanguageModel, rows) -> float:
    """The temperature with the least log-loss on rows that weights were not learnt from."""
    if not rows:
        return 1.0
    logits = np.array([model.logits(used, counts) for _, used, counts in rows])
    label = np.array([r[0] for r in rows])

    def loss(log_t):
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return (np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), label]).mean()

    grid = np.linspace(-3, 3, 121)
    # Where rows are told apart without doubt, ever lower temperatures gain next to nothing: stay near 1.
    return float(np.exp(min(grid, key=lambda t: (round(loss(t), 4), abs(t)))))


def learn(docs: DataFrame, train: Column, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from the text and lang of the rows that ``train`` accepts and whose lang is not null."""
    training = docs.where(train & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    df = document_frequencies(training)
    total = sum(counts.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    drawn = sample_features(training, counts, rows)
    kept_out = drawn[::CALIBRATE]
    used = [r for k, r in enumerate(drawn) if k % CALIBRATE]
    weights, bias = follow_the_leader(used or drawn, idf, len(counts))
    model = LanguageModel(sorted(counts), idf, weights, bias, 1.0)
    return LanguageModel(model.languages, idf, weights, bias, temperature(model, kept_out))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row (``doc_id``, ``text``).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learnt; otherwise one of the learnt languages
    with its probability. Equal probabilities go to the first language in order of code points.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            found = [model.predict(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
