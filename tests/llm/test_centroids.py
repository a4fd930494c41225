import hashlib
import math
import random

import numpy as np
import pytest

from tablelift.llm import centroids
from tablelift.llm.centroids import centroid_clusters

KINDS = "vec_id bigint, embedding array<float>, cluster string, distance string, v string, x string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], KINDS)


def plain(rows, k, rounds, dims):
    kept = []
    for vec, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec, [math.floor(1024 * x) for x in e]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        at = [n for _, n in nearest()]
        for n in range(len(middle)):
            own = [v for (_, v), m in zip(kept, at, strict=True) if m == n]
            if own:
                middle[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    near = nearest()
    total = sum(d for d, _ in near)
    of = {n: sum(d for d, m in near if m == n) for n in range(len(middle))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted((repr((vec, n, d, of[n], total, digest[n])) for (vec, _), (d, n) in zip(kept, near, strict=True)))


def found(df):
    assert df.columns == [c.split()[0] for c in centroids.CLUSTERED.split(", ")]
    return sorted(repr(tuple(r)) for r in df.collect())


def floats(values):
    """As they are once stored as 32-bit numbers."""
    return [None if x is None else float(np.float32(x)) for x in values]


@pytest.fixture
def vectors():
    rng = random.Random(7)
    rows = [(k, floats([rng.gauss(k % 5 / 4, 0.3) for _ in range(4)])) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(300, 420)]  # a hot vector
    rows += [(7, floats([0.1, 0.2, 0.3, 0.4])), (7, floats([0.1, 0.2, 0.3, 0.4])), (None, floats([-1.0, -2.0, 3.0, 0.0]))]
    rows += [(500, None), (501, []), (502, floats([1, 2, 3])), (503, [1.0, None, 2.0, 3.0]), (504, floats([1, 2, 3, 4, 5]))]
    rows += [(505, [1.0, float("nan"), 0.0, 0.0]), (506, [float("inf"), 0.0, 0.0, 0.0]), (507, [0.0, 0.0, float("-inf"), 0.0])]
    return rows


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 0), (1, 2), (500, 2)])
def test_as_the_plain_version(spark, vectors, k, rounds):
    assert found(centroid_clusters(table(spark, vectors), k, rounds, 4)) == plain(vectors, k, rounds, 4)


def test_blocks_do_not_matter(spark, vectors):
    assert found(centroid_clusters(table(spark, vectors).repartition(5), 8, 4, 4, block=7)) == plain(vectors, 8, 4, 4)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(k, [float(k % 2), 0.0]) for k in range(6)] + [(9, [0.5, 0.0])]
    assert found(centroid_clusters(table(spark, rows), 8, 3, 2)) == plain(rows, 8, 3, 2)


def test_largest_components(spark):
    top = (1 << 17) - 1.0
    rows = [(1, [top, -top]), (2, [-top, top]), (3, [0.0, 1e-30]), (4, [-1e-30, 0.0])]
    assert found(centroid_clusters(table(spark, rows), 2, 3, 2)) == plain(rows, 2, 3, 2)
    with pytest.raises(Exception, match="would not fit"):
        centroid_clusters(table(spark, [(1, [float(1 << 17), 0.0])]), 2, 1, 2).collect()


def test_nothing_kept(spark):
    assert found(centroid_clusters(table(spark, []))) == []
    assert found(centroid_clusters(table(spark, [(1, None), (2, [1.0])]))) == []


def test_parameters(spark):
    with pytest.raises(ValueError):
        centroid_clusters(table(spark, []), k=0)
