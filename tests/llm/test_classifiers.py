import math
import zlib

import numpy as np
import pytest

from tablelift.llm import language_id, quality
from tablelift.llm.queries import QUERIES, remainder


def held_out(doc, n, r):
    return zlib.crc32(str(doc).encode()) % n == r


def test_language_on_rows_not_learnt_from(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op6_language_id"](spark, folder).collect()
    assert len(found) == len(truth)
    right = []
    for r in found:
        assert r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == truth[r.doc_id].lang)
    assert np.mean(right) > 0.97


def test_language_of_odd_rows(docs_of, odd):
    base = docs_of([(k, t, lang, "s") for k, (t, lang) in enumerate([("the and of is", "en"), ("der und die ist", "de"), ("xyz", None)] * 9)])
    model = language_id.learn(base, base.doc_id >= 0)
    assert model.languages == ["de", "en"]
    rows = language_id.predict(odd.unionByName(docs_of([(99, "der und die")])), model).collect()
    assert len(rows) == odd.count() + 1
    for r in rows:
        assert r.lang_pred in ("de", "en", "und") and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in rows}
    assert by_id[99].lang_pred == "de"
    assert [by_id[k].lang_pred for k in (1, 2, 3, 9)] == ["und"] * 4


def test_language_without_rows(none, odd):
    model = language_id.learn(none, none.doc_id >= 0)
    assert language_id.predict(none, model).collect() == []
    assert {r.lang_pred for r in language_id.predict(odd, model).collect()} == {"und"}


def test_ngrams_keep_letters_only():
    a, b = language_id.ngram_counts("Ab 12, cé!")[0], language_id.ngram_counts("ab  cÉ")[0]
    assert (a == b).all() and len(a)
    assert not len(language_id.ngram_counts("12 !?")[0])


def test_penalty_makes_weights_sparse():
    draw = np.random.default_rng(1)
    rows = [(k % 2, np.sort(draw.choice(500, 20, False)) + 1000 * (k % 2), np.ones(20)) for k in range(200)]
    few, _ = language_id.follow_the_leader(rows, np.ones(language_id.BUCKETS), 2, l1=1.0)
    many, _ = language_id.follow_the_leader(rows, np.ones(language_id.BUCKETS), 2, l1=0.0)
    assert 0 < (few != 0).sum() < (many != 0).sum()


def test_quality_on_rows_not_learnt_from(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op10_quality"](spark, folder).collect()
    pairs = []
    for r in found:
        assert r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and r.doc_id in truth:
            pairs.append((truth[r.doc_id], r.predicted))
    good, bad = ([p for q, p in pairs if q == k] for k in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_sums_and_density_by_numpy(spark, docs_of, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stats = quality.document_statistics(docs)
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = quality.learn(stats, labels, remainder(3) != 1)
    x = {r.doc_id: r.x for r in stats.collect()}
    rows = [(r.quality, x[r.doc_id]) for r in labels.collect() if not held_out(r.doc_id, 3, 1)]
    matrix, label = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    assert np.allclose(model.centre, matrix.mean(axis=0))
    z = (matrix - model.centre) / model.scale
    common = sum((label == c).mean() * np.cov(z[label == c].T, bias=True) for c in (0, 1))
    density = []
    for c in (0, 1):
        own = z[label == c]
        cov = 0.85 * np.cov(own.T, bias=True) + 0.15 * common
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(cov))
        away = z - own.mean(axis=0)
        mahalanobis = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        density.append(np.log((label == c).mean()) - 0.5 * (np.linalg.slogdet(cov)[1] + mahalanobis))
    expected = 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))
    assert np.allclose(model.score(matrix), expected)


def test_quality_of_odd_and_no_rows(odd, none, spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (7, 0, 0), (9, 0, 1), (9, None, 0), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    stats = quality.document_statistics(odd)
    model = quality.learn(stats, labels, labels.doc_id >= 0)
    rows = quality.score(stats, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert set(quality.keep_good(odd, model).columns) == set(odd.columns)
    assert quality.score(quality.document_statistics(none), model).collect() == []
    assert quality.learn(stats, labels.limit(0), labels.doc_id >= 0) is None
    assert {r.score for r in quality.score(stats, None).collect()} == {0.5}
    assert quality.keep_good(odd, None).count() == odd.count()


def test_follow_the_leader_by_a_plain_version():
    """The same update, one weight at a time, from the formulas of FTRL-Proximal with elastic net."""
    rng = np.random.default_rng(4)
    buckets, classes, alpha, beta, l1, l2 = 12, 3, 0.5, 1.0, 0.02, 0.1
    idf = np.zeros(language_id.BUCKETS)
    idf[:buckets] = 1 + rng.random(buckets)
    rows = []
    for _ in range(40):
        used = np.sort(rng.choice(buckets, rng.integers(1, 6), replace=False))
        rows.append((int(rng.integers(classes)), used, rng.integers(1, 5, len(used)).astype(np.uint32)))
    z, n = {}, {}

    def weight(f, c):
        held = z.get((f, c), 0.0)
        if abs(held) <= l1:
            return 0.0
        return -(held - math.copysign(l1, held)) / ((beta + math.sqrt(n.get((f, c), 0.0))) / alpha + l2)

    for _ in range(3):
        for label, used, counts in rows:
            values = {int(f): math.log(1 + int(c)) * idf[f] for f, c in zip(used, counts, strict=True)}
            length = math.sqrt(sum(v * v for v in values.values()))
            values = {f: v / length for f, v in values.items()} | {"bias": 1.0}
            w = {(f, c): weight(f, c) for f in values for c in range(classes)}
            scores = [math.exp(sum(v * w[f, c] for f, v in values.items())) for c in range(classes)]
            for f, v in values.items():
                for c in range(classes):
                    g = v * (scores[c] / sum(scores) - (c == label))
                    old = n.get((f, c), 0.0)
                    rise = (math.sqrt(old + g * g) - math.sqrt(old)) / alpha
                    z[f, c] = z.get((f, c), 0.0) + g - rise * w[f, c]
                    n[f, c] = old + g * g
    weights, bias = language_id.follow_the_leader(rows, idf, classes)
    for c in range(classes):
        assert bias[c] == pytest.approx(weight("bias", c))
        for f in range(buckets):
            assert weights[f, c] == pytest.approx(weight(f, c))
    assert not weights[buckets:].any()


def test_document_frequencies_and_sample_by_plain_versions(spark):
    rows = [(k % 40, f"some words of text {k % 7} und der", ["en", "de"][k % 2]) for k in range(100)] + [(5, "one hot row", "en")] * 500 + [(6, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    found = language_id.document_frequencies(docs)
    expected = np.zeros(language_id.BUCKETS, np.int64)
    for _, text, _ in rows:
        expected[language_id.ngram_counts(text or "")[0]] += 1
    assert (found == expected).all()
    drawn = language_id.sample_features(docs, {"en": 550, "de": 51}, 60)
    assert 0 < len(drawn) <= 120
    again = language_id.sample_features(docs.repartition(3), {"en": 550, "de": 51}, 60)
    assert [(a[0], a[1].tolist(), a[2].tolist()) for a in drawn] == [(a[0], a[1].tolist(), a[2].tolist()) for a in again]
