"""Centroid clustering (exact Lloyd rounds) of integer vectors by Shallot search.

A vector is turned into integers, floor(scale * x). With its components a row keeps the numbers
of its nearest and its second-nearest centroid of the last round, an upper bound of its distance
to the nearest and a lower bound of its distance to all others. In each round

1. the bounds are moved by how far the centroids went; a row whose upper bound is still below the
   lower one, or below half the way to the next centroid, keeps its centroid without any distance;
2. the others measure the two centroids they remember and start from the closer one;
3. the further centroids are tried in order of their distance from that start. Only those inside
   the ball of radius d(start) + d(second) can come before the second-nearest, so the scan of a row
   ends where the sorted list leaves the ball, and each better second-nearest shrinks it;
4. survivors are compared by squared distances as integers, ties to the smaller number. Floating
   point only serves bounds, widened so that rounding never excludes a centroid.

A round is one pass over the table without a shuffle: rows with their new bounds are written to the
shared folder, the table of the round before is removed. Sums come back as one array per Arrow
batch and are added by component; what reaches the driver is the centroids, k x dimension numbers.
Rounds that no longer move a centroid would repeat each other and are left out.

Defined results: vectors that are null, of another length, or with null or non-finite components
take no part. Rows without an id are clustered, but never start a centroid. Rows that repeat an
id are clustered one by one; of equal hashes the vector whose little-endian bytes are smaller
starts first. With fewer vectors than centroids each vector with an id starts one; without any
the result is empty. Components are exact up to the range of a long; a scaled component, a
distance or an inertia beyond it is an error. Extra columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.llm.common import map_arrow
from mailsieve.session import remove_folder, scratch_path

DIMENSION = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
#: Components below this give squared distances that fit 64 bits in any dimension up to 256.
_SMALL = 1 << 26
#: Bounds are widened by this share; rounding errors of their few operations are far smaller.
_SLACK = 1e-9

_STATE = "vec_id {kind}, v binary, nearest int, second int, upper double, lower double"


def usable(embedding: Column, dimension: int) -> Column:
    """Whether a vector has ``dimension`` components, all of them finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) == dimension) & ~bad, F.lit(False))


def _integers(dimension: int, scale: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            scaled = np.floor(values * scale).reshape(n, dimension)
            if not (np.abs(scaled) < 2.0**63).all():
                raise ValueError("a scaled component is beyond a long")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    _binary(scaled.astype("<i8")),
                    pa.array(np.zeros(n, np.int32)),
                    pa.array(np.ones(n, np.int32)),
                    pa.array(np.full(n, np.inf)),
                    pa.array(np.zeros(n)),
                ],
                ["vec_id", "v", "nearest", "second", "upper", "lower"],
            )

    return work


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as one binary value each."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))]
    )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The other way round, also of a slice of a batch."""
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset] if len(column) else 0
    rows = np.frombuffer(data, "<i8", count=len(column) * dimension, offset=int(start)) if len(column) else np.empty(0, "<i8")
    return rows.reshape(len(column), dimension)


@dataclass
class Centres:
    """Centroids of a round with what the search needs to know about them.

    ``rows`` are exact; ``apart`` are distances between centroids rounded down, each list sorted
    and beginning with the centroid itself; ``half`` is half the way to the nearest other one.
    """

    rows: list[list[int]]
    moved: np.ndarray

    def __post_init__(self):
        k = len(self.rows)
        small = all(abs(x) < _SMALL for row in self.rows for x in row)
        self.exact = np.array(self.rows, dtype=np.int64 if small else object).reshape(k, -1)
        squares = np.array([[_square(a, b) for b in self.rows] for a in self.rows], dtype=np.float64).reshape(k, k)
        apart = np.sqrt(squares) * (1 - _SLACK)
        # The centroid itself comes first, also where others lie on it.
        itself = apart - np.eye(k)
        self.order = np.argsort(itself, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.half = self.apart[:, 1] / 2 if k > 1 else np.full(k, np.inf)
        # How far any other centroid than this one went, at most.
        self.others_moved = np.array([np.delete(self.moved, j).max(initial=0.0) for j in range(k)])


def _square(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _squares(vectors: np.ndarray, centres: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to the centroid of its number."""
    away = vectors - centres[numbers]
    return (away * away).sum(axis=1)


def search(
    vectors: np.ndarray, centres: Centres, nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """nearest, second, upper and lower of all vectors for new centroids."""
    k = len(centres.rows)
    if k == 1:
        n = len(vectors)
        return np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n)
    upper = (upper + centres.moved[nearest]) * (1 + _SLACK)
    lower = np.maximum(lower - centres.others_moved[nearest], 0) * (1 - _SLACK)
    open_ = np.flatnonzero(~((upper < lower) | (upper < centres.half[nearest])))
    if not len(open_):
        return nearest, second, upper, lower
    nearest, second = nearest.copy(), second.copy()

    # Start from the closer one of the two remembered centroids.
    x, a, b = vectors[open_], nearest[open_], second[open_]
    to_a, to_b = _squares(x, centres.exact, a), _squares(x, centres.exact, b)
    turned = (to_b < to_a) | ((to_b == to_a) & (b < a))
    a, b = np.where(turned, b, a), np.where(turned, a, b)
    best, next_best = np.where(turned, to_b, to_a), np.where(turned, to_a, to_b)
    start, reach = a.copy(), np.sqrt(best.astype(np.float64)) * (1 + _SLACK)
    remembered = b.copy()
    left = np.arange(len(open_))
    for step in range(1, k):
        ball = reach[left] + np.sqrt(next_best[left].astype(np.float64)) * (1 + _SLACK)
        left = left[centres.apart[start[left], step] <= ball]
        if not len(left):
            break
        tried = centres.order[start[left], step]
        fresh = tried != remembered[left]
        rows, tried = left[fresh], tried[fresh]
        found = _squares(x[rows], centres.exact, tried)
        first = (found < best[rows]) | ((found == best[rows]) & (tried < a[rows]))
        then = ~first & ((found < next_best[rows]) | ((found == next_best[rows]) & (tried < b[rows])))
        at = rows[first]
        next_best[at], b[at] = best[at], a[at]
        best[at], a[at] = found[first], tried[first]
        at = rows[then]
        next_best[at], b[at] = found[then], tried[then]
    nearest[open_], second[open_] = a, b
    upper[open_] = np.sqrt(best.astype(np.float64)) * (1 + _SLACK)
    lower[open_] = np.sqrt(next_best.astype(np.float64)) * (1 - _SLACK)
    return nearest, second, upper, lower


def _searched(batch: pa.RecordBatch, centres: Centres):
    vectors = _matrix(batch.column(1), centres.exact.shape[1])
    if centres.exact.dtype == object or np.abs(vectors).max(initial=0) >= _SMALL or vectors.min(initial=0) < -_SMALL:
        vectors = vectors.astype(object)
    state = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
    return vectors, search(vectors, centres, *state)


def _sums(vectors: np.ndarray, nearest: np.ndarray, k: int) -> list[str]:
    """For each centroid the sums of its vectors' components, then their number, end to end."""
    rows = []
    for j in range(k):
        mine = vectors[nearest == j]
        exact = mine.sum(axis=0) if len(mine) else [0] * vectors.shape[1]
        rows += [*map(int, exact), len(mine)]
    return [str(x) for x in rows]


def _round(centres: Centres):
    """Rows with new bounds; the first row of a batch carries the sums of all of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, state = _searched(batch, centres)
            sums = [_sums(vectors, state[0], len(centres.rows)), *[None] * (batch.num_rows - 1)][: batch.num_rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, state), pa.array(sums, pa.list_(pa.string()))],
                ["vec_id", "v", "nearest", "second", "upper", "lower", "sums"],
            )

    return work


def _last(centres: Centres):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, (nearest, *_) = _searched(batch, centres)
            away = _squares(vectors, centres.exact, nearest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nearest, pa.int32()), pa.array(away.tolist(), pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return work


def _stored(spark: SparkSession, frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def _starts(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where(F.col("vec_id").isNotNull()).select("v", order.alias("hash"))
    found = first.orderBy("hash", "v").limit(k).collect()  # k rows
    return [np.frombuffer(r.v, "<i8").tolist() for r in found]


def _moved(before: list[list[int]], after: list[list[int]]) -> np.ndarray:
    return np.array([np.sqrt(float(_square(a, b))) * (1 + _SLACK) for a, b in zip(before, after, strict=True)])


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each usable vector, and the final centroids."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    state = _STATE.format(kind=kind)
    kept = vectors.where(usable(vectors[vector_col], dimension)).select(
        vectors[id_col].alias("vec_id"), vectors[vector_col].alias("v")
    )
    rows, path = _stored(spark, map_arrow(kept, _integers(dimension, scale), state), "vectors")
    centroids = _starts(rows, k, seed)
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), []
    centres = Centres(centroids, np.zeros(len(centroids)))
    for _ in range(rounds):
        assigned = map_arrow(rows.select("vec_id", "v", "nearest", "second", "upper", "lower"), _round(centres), f"{state}, sums array<string>")
        rows, done = _stored(spark, assigned, "vectors")
        remove_folder(spark, path)
        path = done
        totals = (
            rows.where("sums is not null")
            .select(F.posexplode("sums").alias("at", "x"))
            .groupBy("at")
            .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
            .orderBy("at")
            .collect()  # k x (dimension + 1) rows
        )
        width = dimension + 1
        sums = [int(r.x) for r in totals]
        after = []
        for j, old in enumerate(centroids):
            *total, n = sums[j * width : (j + 1) * width] or [0]
            after.append([x // n for x in total] if n else old)
        centres = Centres(after, _moved(centroids, after))
        if after == centroids:
            break
        centroids = after
    found, done = _stored(
        spark,
        map_arrow(
            rows.select("vec_id", "v", "nearest", "second", "upper", "lower"),
            _last(centres),
            f"vec_id {kind}, cluster int, distance bigint",
        ),
        "clustered",
    )
    remove_folder(spark, path)
    return found, centroids


def summary(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Rows of ``cluster`` with cluster_inertia, inertia and centroid_sha256.

    One row per cluster is joined by broadcast: as many as there are centroids.
    """
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids]
    distance = F.col("distance").cast("decimal(38,0)")
    sizes = found.groupBy("cluster").agg(F.sum(distance).alias("own"))
    total = sizes.agg(F.sum("own")).scalar()
    per_cluster = sizes.select(
        "cluster",
        F.col("own").cast("long").alias("cluster_inertia"),
        total.cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)).cast("array<string>"), F.col("cluster")).alias("centroid_sha256"),
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
