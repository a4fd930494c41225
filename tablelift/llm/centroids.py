"""Clustering of vectors around centroids in whole numbers, by tables of squared differences.

Components are turned into integers once. Vectors are then staged in blocks of a few thousand: a block holds, for each dimension, the
integer values that occur in it and the place of each vector's value among them. In a round, a task tabulates the squared difference
of every dimension, occurring value and centroid of a block; the distance of a vector is a sum of gathers from that table, and the
sums of the clusters come from counting table rows. A block's table is bounded by the block, whatever values occur in the whole input.

All sums are whole numbers, so neither the order of tasks nor a repeated task changes a result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.session import stage

SCALE = 1024
#: Vectors of one block; places in a block fit 16 bits.
BLOCK = 4096
#: Components are less than this in size once scaled, so that a squared distance of 64 of them fits 64 bits.
LARGEST = 1 << 27
BLOCKS = "vec_ids array<bigint>, sizes binary, occurring binary, places binary"
CLUSTERED = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def whole_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """``vec_id, v``: the vectors of exactly ``dims`` components, none null or not finite, as integers ``floor(SCALE * x)``."""
    x = F.col("embedding").cast("array<double>")

    def whole(e: Column) -> Column:
        too_large = F.raise_error(F.lit(f"a component times {SCALE} is {LARGEST} or more; squared distances would not fit")).cast("bigint")
        return F.when(F.abs(e * SCALE) < LARGEST, F.floor(e * SCALE)).otherwise(too_large)

    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    good = vectors.select("vec_id", x.alias("x")).where((F.size("x") == dims) & finite)
    return good.select("vec_id", F.transform("x", whole).alias("v"))


def blocks_of(whole: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """The vectors in blocks: their ids, the number of occurring values of each dimension, these values, and the vectors' places in them."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                few = batch.slice(at, block)
                matrix = few.column(1).flatten().to_numpy().reshape(-1, dims).T
                found = [np.unique(row, return_inverse=True) for row in matrix]
                sizes = np.array([len(values) for values, _ in found], np.int32)
                places = np.stack([p.astype(np.uint16) for _, p in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([few.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes.tobytes()], pa.binary()),
                        pa.array([np.concatenate([values for values, _ in found]).astype(np.int64).tobytes()], pa.binary()),
                        pa.array([places.tobytes()], pa.binary()),
                    ],
                    names=["vec_ids", "sizes", "occurring", "places"],
                )

    return stage(whole.mapInArrow(run, BLOCKS), "blocks")


class Block:
    """One block in a task."""

    def __init__(self, sizes: bytes, occurring: bytes, places: bytes, dims: int):
        sizes = np.frombuffer(sizes, np.int32)
        self.values = np.frombuffer(occurring, np.int64)
        self.dimension = np.repeat(np.arange(dims), sizes)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.rows = np.frombuffer(places, np.uint16).reshape(dims, -1) + self.starts[:, None]  # of the table, for each vector

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector; of centroids equally near, the one of the smaller number."""
        table = (self.values[:, None] - centroids.T[self.dimension]) ** 2  # occurring values of all dimensions, centroids
        distances = np.zeros((self.rows.shape[1], len(centroids)), np.int64)
        for of_dimension in self.rows:
            distances += table[of_dimension]
        cluster = distances.argmin(axis=1)
        return cluster, distances[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Component sums of each cluster (k, dims), from how often each table row occurs in it."""
        times = np.bincount((self.rows * k + cluster).ravel(), minlength=len(self.values) * k).reshape(-1, k)
        return np.add.reduceat(times * self.values[:, None], self.starts, axis=0).T


def unpacked(batches, dims: int):
    """Ids and block of each row of batches of ``BLOCKS``."""
    for batch in batches:
        sizes, occurring, places = (batch.column(c).to_pylist() for c in range(1, 4))
        for k in range(batch.num_rows):
            yield batch.column(0)[k].values, Block(sizes[k], occurring[k], places[k], dims)


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``<seed>:<vec_id>`` has the smallest SHA-256; equal ids in the order of their components, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([row["v"] for row in rows], np.int64)


def next_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The componentwise floor of each cluster's mean; a cluster without vectors keeps its centroid. The driver gets a row for each component."""
    k, dims = centroids.shape

    def run(batches):
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, block in unpacked(batches, dims):
            cluster, _ = block.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            totals += block.sums(cluster, k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k), dims).astype(np.int32)),
                pa.array(np.tile(np.arange(dims), k).astype(np.int32)),
                pa.array(np.repeat(counts, dims)),
                pa.array(totals.ravel()),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    sums = blocks.mapInArrow(run, "cluster int, dim int, n bigint, total bigint").groupBy("cluster", "dim")
    wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = centroids.copy()
    for row in sums.agg(F.sum("n").alias("n"), wide).where("n > 0").collect():
        found[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return found


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for ids, block in unpacked(batches, dims):
            cluster, distance = block.nearest(centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return blocks.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, block: int = BLOCK) -> DataFrame:
    """The cluster of every vector after ``rounds`` rounds, in the columns of ``CLUSTERED``, one row for each vector that is kept.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Kept are vectors of exactly ``dims`` components, none null or
    not finite; a null embedding is not kept. Rows that repeat a ``vec_id``, or lack it, are vectors of their own. With fewer than ``k``
    kept vectors there are as many centroids; equal centroids leave the later one empty, and an empty one stays where it is. An empty
    table, or one without a kept vector, gives an empty result. ``block`` sets how many vectors share a table, not the result. A component whose integer is ``LARGEST`` or more in size is an error, as
    squared distances would not fit 64 bits.
    """
    if not (k >= 1 and rounds >= 0 and 1 <= dims <= 64 and 1 <= block <= 1 << 16):
        raise ValueError("k must be 1 or more, rounds 0 or more, dims from 1 to 64 and block from 1 to 65536")
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, dims)
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], CLUSTERED)
    blocks = blocks_of(whole, dims, block)
    for _ in range(rounds):
        centroids = next_centroids(blocks, centroids)
    found = stage(assigned(blocks, centroids), "assigned")
    sums = {row["cluster"]: int(row["s"]) for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select(*[c.split()[0] for c in CLUSTERED.split(", ")])  # at most k rows


def clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """The SQL with the same rows, a pair of tables for each round."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
)""",
        f"""c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM kept
    QUALIFY cluster < {k}
)""",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (
    SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d, cluster)) AS near
    FROM (SELECT row, vec_id, v, cluster, {distance} AS d FROM (SELECT *, row_number() OVER () AS row FROM kept), c{n})
    GROUP BY row
)"""
        )
        if n < rounds:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(mean, c) AS c FROM c{n} LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY dim) AS mean FROM (
            SELECT near.cluster AS cluster, dim, sum(x)::BIGINT AS s, count(*) AS n
            FROM (SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM a{n}) GROUP BY ALL
        ) GROUP BY cluster
    ) USING (cluster)
)"""
            )
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.near.cluster AS cluster, a.near.d AS distance,
       CAST(sum(a.near.d) OVER (PARTITION BY a.near.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.near.cluster
"""
    )
