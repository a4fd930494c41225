"""Text quality by a regularised quadratic discriminant.

A text becomes ``FEATURES`` transformed statistics: lengths, shares of kinds of characters, repetition of words and lines.
Each class of the labels is a normal distribution over them. Its covariance is shrunk twice: towards the pooled one and
towards its own diagonal. The score is the logistic of the difference of log-densities, which takes the Mahalanobis distances
from Cholesky factors computed once. Sums for means and covariances are taken over all labelled rows by Spark; the driver
gets one row a class.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm.text import Words, runs_of_rows

FEATURES = (
    "log_words", "log_word_length", "word_length_spread", "upper", "digits", "marks", "rare_marks", "word_end_marks", "bars",
    "distinct_words", "same_as_before", "log_top_word", "distinct_lines", "log_line_words", "sentence_ends", "capital_words",
    "non_ascii", "repeated_pairs", "short_words", "log_longest",
)
SMALLEST = 1e-3
#: Bytes of text worked on at a time in a task, about; each takes some 100 bytes of memory.
RUN = 1 << 18


def logit(share):
    share = np.clip(share, SMALLEST, 1 - SMALLEST)
    return np.log(share / (1 - share))


def byte_kinds() -> dict[str, np.ndarray]:
    every = np.arange(256)
    letter = ((every >= 65) & (every <= 90)) | ((every >= 97) & (every <= 122))
    digit = (every >= 48) & (every <= 57)
    mark = (every > 32) & (every < 127) & ~letter & ~digit
    common = np.isin(every, [ord(c) for c in ".,;:!?'\"()-"])
    return {
        "upper": (every >= 65) & (every <= 90),
        "digits": digit,
        "marks": mark,
        "rare_marks": mark & ~common,
        "non_ascii": every >= 128,
        "ends": np.isin(every, [ord(c) for c in ".!?"]),
    }


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text; a text without words gets those of zero counts."""
    words, kinds = Words(lower=False), byte_kinds()
    out = np.zeros((len(column), len(FEATURES)))
    for first, data, offsets in runs_of_rows(column, RUN):
        starts, ends, hashes, place = words.of(data, offsets)
        sizes = ends - starts
        running = {k: np.concatenate([[0], np.cumsum(table[data])]) for k, table in kinds.items()}
        tail = np.zeros(len(starts), bool) if not len(starts) else kinds["rare_marks"][data[ends - 1]]
        capital = np.zeros(len(starts), bool) if not len(starts) else kinds["upper"][data[starts]]
        lines = np.flatnonzero(data == 10)
        for k in range(len(offsets) - 1):
            a, b, x, y = int(place[k]), int(place[k + 1]), int(offsets[k]), int(offsets[k + 1])
            n, size = max(1, b - a), max(1, y - x)
            own, length = hashes[a:b], sizes[a:b]
            share = {j: (c[y] - c[x]) / size for j, c in running.items()}
            _, counts = np.unique(own, return_counts=True)
            pairs = own[1:] * np.uint64(31) + own[:-1]
            breaks = lines[np.searchsorted(lines, x) : np.searchsorted(lines, y)]
            at = np.unique(np.concatenate([[a], np.searchsorted(starts, breaks)]))
            at = at[at < b]
            line_sums = np.add.reduceat(own, at - a) if len(at) else own[:0]
            out[first + k] = (
                np.log1p(b - a),
                np.log1p(length.mean() if b > a else 0),
                np.log1p(length.std() if b > a else 0),
                logit(share["upper"]),
                logit(share["digits"]),
                logit(share["marks"]),
                logit(share["rare_marks"]),
                logit(tail[a:b].sum() / n),
                logit((length == 1).sum() / n),
                logit(len(counts) / n),
                logit((own[1:] == own[:-1]).sum() / n),
                np.log((counts.max() if len(counts) else 0) / n + 0.01),
                logit(len(np.unique(line_sums)) / max(1, len(line_sums))),
                np.log1p(n / max(1, len(line_sums))),
                logit(share["ends"]),
                logit(capital[a:b].sum() / n),
                logit(share["non_ascii"]),
                logit(1 - len(np.unique(pairs)) / max(1, len(pairs))),
                logit((length <= 3).sum() / n),
                np.log1p(length.max() if b > a else 0),
            )
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the transformed statistics of each text, as an array of doubles."""

    def run(batches):
        for batch in batches:
            flat = pa.array(statistics(batch.column(1)).ravel())
            places = pa.array(np.arange(batch.num_rows + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(places, flat)], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-densities' constants of classes 0 and 1, for scaled statistics."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        z = (x - self.centre) / self.scale
        density = [
            c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def class_sums(x: DataFrame, groups: int = 64) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Number of rows, sum and sum of outer products of ``x`` for each ``label``, over all rows."""
    width = len(FEATURES)

    def run(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            label = batch.column(0).to_numpy()
            rows = batch.column(1).flatten().to_numpy().reshape(-1, width)
            for c in np.unique(label):
                own = rows[label == c]
                old = kept.setdefault(int(c), [0, np.zeros(width), np.zeros((width, width))])
                old[0] += len(own)
                old[1] += own.sum(axis=0)
                old[2] += own.T @ own
        for c, (n, s, p) in kept.items():
            flat = np.concatenate([[n], s, p.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["label", "sums"]
            )

    parts = x.select("label", "x").mapInArrow(run, "label int, sums array<double>")
    long = parts.select("label", F.posexplode("sums").alias("k", "v")).groupBy("label", "k").agg(F.sum("v").alias("v"))
    out = {}
    for row in long.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("s")).collect():
        flat = np.array([e.v for e in row.s])
        out[row.label] = (int(flat[0]), flat[1 : width + 1], flat[width + 1 :].reshape(width, width))
    return out


def fit(sums: dict, pooled: float = 0.15, diagonal: float = 0.1, equal_priors: bool = False) -> Discriminant | None:
    """The discriminant from class sums; None if a class has no rows.

    ``pooled`` and ``diagonal`` say how far a class covariance is shrunk to the pooled one and then to its diagonal.
    """
    if not {0, 1} <= sums.keys():
        return None
    n = np.array([sums[c][0] for c in (0, 1)], float)
    centre = (sums[0][1] + sums[1][1]) / n.sum()
    second = (sums[0][2] + sums[1][2]) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(second) - centre**2, 1e-6))
    means, covariances = [], []
    for c in (0, 1):
        mean = sums[c][1] / n[c]
        covariances.append((sums[c][2] / n[c] - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    common = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    factors, constants = [], []
    for c in (0, 1):
        cov = (1 - pooled) * covariances[c] + pooled * common
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(cov))
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        prior = 0.5 if equal_priors else n[c] / n.sum()
        constants.append(np.log(prior) - np.log(np.diag(low)).sum())
    return Discriminant(centre, scale, np.array(means), np.array(factors), np.array(constants))


def learn(stats: DataFrame, labels: DataFrame, train: Column) -> Discriminant | None:
    """Fit on the rows of ``labels`` (``doc_id``, ``quality``) that ``train`` accepts.

    Labels other than 0 and 1 are left out; a document with several labels counts with each.
    """
    own = labels.where(train & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    return fit(class_sums(stats.join(own, "doc_id")))


def score(stats: DataFrame, model: Discriminant | None) -> DataFrame:
    """``doc_id, score, predicted``: 0.5 and 1 for every row if there is no model."""
    shared = stats.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            found = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double, predicted int")


def keep_good(docs: DataFrame, model: Discriminant | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores 0.5 or more; all rows if there is no model."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    at = docs.columns.index("text")

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            good = model.score(statistics(batch.column(at))) >= 0.5 if model else np.ones(batch.num_rows, bool)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
