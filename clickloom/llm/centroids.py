"""Centroid clustering of 64-component vectors by bit planes and popcounts.

Components become integers in two's complement. Bit ``i`` of all 64 components of a vector is
one 64-bit word, its plane ``i``; the plane of the sign bit weighs ``-2**i``, the others ``2**i``.
The dot product of two vectors is then the sum over all pairs of planes of the product of their
weights and the number of common bits (AND, then popcount), exact in integers, and with the
squared lengths it gives the exact squared distance. A vector is kept with as many planes as its
batch needs; repeating the sign plane widens it.

Vectors are packed once into a table. A round is one scan of it: each task assigns its vectors
and hands on at most one row of sums per centroid, so no cluster is too large for a task. Only
the centroids (``k`` times 64 integers) ever reach the driver and travel to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.vectors import finite_rows
from clickloom.workspace import materialize

WIDTH = 64
# Differences below 2**28 keep a squared distance of 64 components within a long.
LARGEST = 1 << 27
# Distances to so many centroids are held for a batch at a time.
BLOCK = 128


def pack(x: np.ndarray) -> np.ndarray:
    """Planes (rows, bits) of integer vectors (rows, 64), the sign plane last."""
    bits = int(np.where(x < 0, ~x, x).max(initial=0)).bit_length() + 1
    planes = np.empty((len(x), bits), np.uint64)
    for i in range(bits):
        planes[:, i] = np.packbits((x >> i & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def unpack_bits(planes: np.ndarray) -> np.ndarray:
    """Bits (rows, planes, 64) of planes."""
    raw = np.ascontiguousarray(planes.astype("<u8")).view(np.uint8)
    return np.unpackbits(raw, axis=1, bitorder="little").reshape(*planes.shape, WIDTH)


def weights(bits: int) -> np.ndarray:
    """What a set bit of each plane counts."""
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def unpack(planes: np.ndarray) -> np.ndarray:
    """Integer vectors of planes."""
    return np.tensordot(unpack_bits(planes).astype(np.int64), weights(planes.shape[1]), (1, 0))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products (rows of ``a``, rows of ``b``) of vectors given by their planes."""
    wa, wb = weights(a.shape[1]).tolist(), weights(b.shape[1]).tolist()
    total = np.zeros((len(a), len(b)), np.int64)
    for i, u in enumerate(wa):
        for j, v in enumerate(wb):
            total += np.bitwise_count(a[:, i, None] & b[None, :, j]) * np.int64(u * v)
    return total


def lengths(planes: np.ndarray) -> np.ndarray:
    """Exact squared lengths, from the common bits of a vector's own planes."""
    w = weights(planes.shape[1]).tolist()
    total = np.zeros(len(planes), np.int64)
    for i, u in enumerate(w):
        for j, v in enumerate(w):
            total += np.bitwise_count(planes[:, i] & planes[:, j]) * np.int64(u * v)
    return total


@dataclass(frozen=True)
class Centroids:
    """Integer centroids (k, 64), numbered from 0."""

    x: np.ndarray

    def __len__(self) -> int:
        return len(self.x)

    def nearest(self, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid; the smaller number on ties."""
        own, mine = pack(self.x), lengths(planes)
        squares = lengths(own)
        best = np.zeros(len(planes), np.int64)
        least = np.full(len(planes), np.iinfo(np.int64).max)
        for begin in range(0, len(own), BLOCK):
            part = slice(begin, begin + BLOCK)
            distance = mine[:, None] + squares[None, part] - 2 * dots(planes, own[part])
            at = distance.argmin(axis=1)
            found = distance[np.arange(len(planes)), at]
            closer = found < least
            best[closer], least[closer] = at[closer] + begin, found[closer]
        return best, least

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components as decimal integers joined by commas."""
        return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in self.x.tolist()]


def _pack_batches(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = finite_rows(batch.column("vector"), WIDTH)
            x = np.floor(values * scale)
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: distances would not fit a long")
            planes = pack(x.astype(np.int64))
            raw = planes.astype("<u8").tobytes()
            step = 8 * planes.shape[1]
            yield pa.record_batch(
                [batch.column("id").take(pa.array(rows)),
                 pa.array([raw[i : i + step] for i in range(0, len(raw), step)], pa.binary())],
                ["id", "planes"],
            )

    return run


def pack_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id, planes`` of the vectors of 64 components, none NULL or non-finite."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("planes", T.BinaryType())])
    return rows.mapInArrow(_pack_batches(scale), schema)


def _batch_planes(column: pa.Array) -> np.ndarray:
    """Planes of stored vectors; those of fewer planes are widened by their sign plane."""
    values = column.to_pylist()
    most = max((len(v) for v in values), default=8)
    wide = b"".join(v if len(v) == most else v + v[-8:] * ((most - len(v)) // 8) for v in values)
    return np.frombuffer(wide, "<u8").reshape(len(values), most // 8).astype(np.uint64)


def _sum_batches(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count, spread = np.zeros(k, np.int64), np.zeros(k, np.int64)
        total = np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            planes = _batch_planes(batch.column("planes"))
            if not len(planes):
                continue
            cluster, distance = centroids.nearest(planes)
            order = np.argsort(cluster, kind="stable")
            here, first = np.unique(cluster[order], return_index=True)
            ones = np.add.reduceat(unpack_bits(planes[order]), first, axis=0, dtype=np.int64)
            total[here] += np.tensordot(ones, weights(planes.shape[1]), (1, 0))
            count[here] += np.diff(np.append(first, len(order)))
            spread[here] += np.add.reduceat(distance[order], first)
        used = np.flatnonzero(count)
        yield pa.record_batch(
            [pa.array(used), pa.array(count[used]), pa.array(spread[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            ["cluster", "count", "inertia", "sums"],
        )

    return run


def cluster_sums(packed: DataFrame, centroids: Centroids) -> dict[int, tuple[int, int, list[int]]]:
    """Count, inertia and component sums of every non-empty cluster, exact.

    Tasks add up their own vectors first; what is shuffled is a row per task and centroid.
    """
    parts = packed.select("planes").mapInArrow(
        _sum_batches(centroids), "cluster long, count long, inertia long, sums array<long>"
    )

    def total(column: Column) -> Column:
        return F.sum(column.cast("decimal(38,0)"))

    rows = parts.groupBy("cluster").agg(
        total(F.col("count")).alias("count"), total(F.col("inertia")).alias("inertia"),
        F.array(*(total(F.col("sums")[i]) for i in range(WIDTH))).alias("sums"),
    ).collect()
    return {r["cluster"]: (int(r["count"]), int(r["inertia"]), [int(v) for v in r["sums"]]) for r in rows}


def first_centroids(packed: DataFrame, k: int = 8, seed: int = 3) -> Centroids:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``.

    Rows of one id are told apart by their components; rows without an id come last.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = packed.orderBy(digest.asc_nulls_last(), "planes").limit(k).select("planes").collect()
    if not chosen:
        return Centroids(np.zeros((0, WIDTH), np.int64))
    planes = _batch_planes(pa.array([bytes(r["planes"]) for r in chosen], pa.binary()))
    return Centroids(unpack(planes))


def refine(packed: DataFrame, centroids: Centroids, rounds: int = 10) -> Centroids:
    """Rounds of assignment and replacement by the floor of the mean; empty clusters stay.

    A round that changes no centroid would only repeat itself, so it is the last.
    """
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.x.copy()
        for cluster, (count, _, sums) in cluster_sums(packed, centroids).items():
            moved[cluster] = [s // count for s in sums]
        if np.array_equal(moved, centroids.x):
            break
        centroids = Centroids(moved)
    return centroids


def _assign_batches(centroids: Centroids, found: dict[int, tuple[int, int, list[int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = pa.array(centroids.digests(), pa.string())
        own = np.array([found.get(j, (0, 0))[1] for j in range(len(centroids))], np.int64)
        whole = sum(own.tolist())
        for batch in batches:
            planes = _batch_planes(batch.column("planes"))
            if not len(planes):
                continue
            cluster, distance = centroids.nearest(planes)
            yield pa.record_batch(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(own[cluster]),
                 pa.array(np.full(len(cluster), whole)), digests.take(pa.array(cluster))],
                ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
            )

    return run


def assign(packed: DataFrame, centroids: Centroids, vec_id: str = "vec_id") -> DataFrame:
    """Cluster and squared distance of every packed vector, with the inertia of its cluster and
    of all, and the digest of its centroid. Inertias are longs; one that needs more is an error."""
    schema = T.StructType([
        T.StructField(vec_id, packed.schema["id"].dataType), T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType()),
    ])
    if not len(centroids):
        return packed.sparkSession.createDataFrame([], schema)
    found = cluster_sums(packed, centroids)
    renamed = T.StructType([T.StructField("id", packed.schema["id"].dataType), *schema.fields[1:]])
    return packed.mapInArrow(_assign_batches(centroids, found), renamed).withColumnRenamed("id", vec_id)


def cluster_vectors(
    vectors: DataFrame, k: int = 8, rounds: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
    scale: int = 1024, seed: int = 3,
) -> DataFrame:
    """Cluster all vectors that have 64 components, none NULL or non-finite; others are left out.

    A component ``x`` counts as ``floor(scale * x)``; one beyond 2**27 is an error. Every row is a
    vector of its own, also if its id or components repeat; a NULL id stays NULL. With fewer
    vectors than ``k`` each is a first centroid. Other columns are not read, and an empty table
    gives an empty result.
    """
    packed = materialize(pack_vectors(vectors, vec_id, vector, scale), "planes")
    centroids = refine(packed, first_centroids(packed, k, seed), rounds)
    return assign(packed, centroids, vec_id)
