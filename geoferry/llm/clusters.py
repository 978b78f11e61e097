"""Clusters of vectors around centroids of whole numbers, with distances from scalar lookup tables.

Components become whole numbers, ``floor(SCALE * x)``, and a dimension takes few of them. Vectors are written once in
blocks of ``BLOCK``, each a row of bytes: the distinct numbers of each dimension, and for each vector where its own
stand among them. In each round a task tabulates, for every dimension, number and centroid, the squared difference, and
adds up what its vectors look up: no difference is computed twice in a block, and the tables take no more than the
block. Sums and counts of the clusters leave a block as whole numbers and are added by Spark; the driver gets one row
for each centroid and round. All arithmetic is on 64-bit integers, so the order of rows and tasks changes nothing.

Kept are vectors of exactly ``DIMENSIONS`` components, none null, not a number or infinite; other rows are left out.
The first centroids are the vectors with the least hash of their id; of equal hashes, as repeated ids and null ids
(which hash as an empty number) have them, the least vector. With fewer vectors than centroids there are fewer
centroids, and an empty table gives an empty result. Components beyond 2^26 after scaling raise an error, for their
squared distances would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch, staged

#: Fixed values of the contract.
DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Vectors of a block, and the largest whole number whose squared distances are sure to fit.
BLOCK, LARGEST = 4096, 1 << 26


def kept_vectors(rows: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the whole numbers of each vector that is kept."""
    value = F.col(f"`{vector}`").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.select(F.col(f"`{key}`").alias("vec_id"), value.alias("v")).where((F.size("v") == dimensions) & F.forall("v", finite)).select(
        "vec_id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)).alias("q")
    )


def first_centroids(vectors: DataFrame, n: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ``seed:vec_id`` has the least sha256, in the order of the hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = vectors.select(mark.alias("mark"), "q").orderBy("mark", "q").limit(n).collect()
    return np.array([row.q for row in found], np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of at most ``BLOCK`` vectors: ids, the numbers of each dimension, how many there are, and places in them."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            q = some.column(1).flatten().to_numpy().reshape(some.num_rows, -1)
            if q.max() > LARGEST or q.min() < -LARGEST:
                raise ArithmeticError(f"a component is beyond {LARGEST} after scaling")
            found = [np.unique(column, return_inverse=True) for column in q.T]
            numbers = np.concatenate([numbers for numbers, _ in found])
            places = np.stack([place for _, place in found]).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [pa.array([some.column(0).to_pylist()], pa.list_(some.schema.field(0).type)), pa.array([numbers.astype("<i8").tobytes()], pa.binary()),
                 pa.array([np.array([len(numbers) for numbers, _ in found], "<i4").tobytes()], pa.binary()), pa.array([places.tobytes()], pa.binary())],
                names=["ids", "numbers", "sizes", "places"],
            )


class Block:
    def __init__(self, numbers, sizes, places) -> None:
        self.sizes = np.frombuffer(sizes.as_buffer(), "<i4")
        self.numbers = np.split(np.frombuffer(numbers.as_buffer(), "<i8"), np.cumsum(self.sizes)[:-1])
        self.places = np.frombuffer(places.as_buffer(), "<u2").reshape(len(self.sizes), -1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid, the first of equally near ones, and its squared distance."""
        distances = np.zeros((self.places.shape[1], len(centroids)), np.int64)
        for numbers, places, centers in zip(self.numbers, self.places, centroids.T):
            table = (numbers[:, None] - centers[None, :]) ** 2
            distances += table[places]
        cluster = distances.argmin(axis=1)
        return cluster, distances[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, n: int) -> np.ndarray:
        """Component sums of each cluster: how often each number occurs in it, times the number."""
        out = np.zeros((n, len(self.numbers)), np.int64)
        for dimension, (numbers, places) in enumerate(zip(self.numbers, self.places)):
            times = np.bincount(cluster * len(numbers) + places, minlength=n * len(numbers))
            out[:, dimension] = times.reshape(n, -1) @ numbers
        return out


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, Block]]:
    for batch in batches:
        for ids, *rest in zip(*batch.columns):
            yield ids, Block(*rest)


def one_round(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after everything was assigned to its nearest: floors of the means, exactly."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, block in _blocks_of(batches):
            cluster, _ = block.nearest(centroids)
            n += np.bincount(cluster, minlength=len(centroids))
            sums += block.sums(cluster, len(centroids))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n), pa.array(list(sums), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    added = stored.mapInArrow(add_up, "cluster long, n long, sums array<long>")
    places = [F.sum(F.col("sums")[at]).alias(f"s{at}") for at in range(centroids.shape[1])]
    moved = centroids.copy()
    for cluster, n, *sums in added.groupBy("cluster").agg(F.sum("n"), *places).collect():
        if n:
            moved[cluster] = [total // n for total in sums]
    return moved


def clusters(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    n_centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    spark, scratch = rows.sparkSession, Scratch()
    vectors = kept_vectors(rows, key, vector, dimensions, scale)
    kind = rows.schema[key].dataType.simpleString()
    stored = scratch.stage(vectors.mapInArrow(blocks, f"ids array<{kind}>, numbers binary, sizes binary, places binary"), "blocks")
    centroids = first_centroids(vectors, n_centroids, seed)
    if not len(centroids):
        scratch.drop(spark)
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = one_round(stored, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks_of(batches):
            cluster, distance = block.nearest(centroids)
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = staged(stored.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    scratch.drop(spark)
    totals = {row.cluster: row.total for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    marks = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids.tolist()]
    of_cluster = lambda values: F.element_at(F.array(*[F.lit(value) for value in values]), F.col("cluster") + 1)
    sums: list[Column] = [of_cluster([totals.get(cluster, 0) for cluster in range(len(centroids))]).cast("long")]
    return assigned.select(
        "vec_id", "cluster", "distance", sums[0].alias("cluster_inertia"), F.lit(sum(totals.values())).cast("long").alias("inertia"), of_cluster(marks).alias("centroid_sha256")
    )
