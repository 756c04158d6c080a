import hashlib
import math
import random

import numpy as np
import pytest

from mailsieve.llm import centroids as C
from mailsieve.llm.queries import op11_centroids


def plain(rows, k=8, rounds=10, dimension=64, seed=3):
    """Lloyd's rounds with every distance, in Python integers."""
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    starts = sorted(
        (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), np.array(v, "<i8").tobytes(), v) for i, v in kept if i is not None
    )
    centres = [v for _, _, v in starts[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds if centres else 0):
        mine = [[] for _ in centres]
        for _, v in kept:
            mine[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for m, c in zip(mine, centres, strict=True)]
    if not centres:
        return []
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = [sum(d for _, j, d in found if j == c) for c in range(len(centres))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, own[j], sum(own), digests[j]) for i, j, d in found), key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert found(op11_centroids(spark, small)) == plain(rows)


def clumps(seed, n=300, dimension=3):
    draw = random.Random(seed)
    middles = [[draw.uniform(-2, 2) for _ in range(dimension)] for _ in range(6)]
    rows = [(i, [x + draw.gauss(0, 0.2) for x in draw.choice(middles)]) for i in range(n)]
    # Ties: many equal vectors, and vectors on a coarse grid.
    rows += [(1000 + i, [0.5] * dimension) for i in range(60)]
    return rows + [(2000 + i, [draw.randrange(-2, 3) / 1024 for _ in range(dimension)]) for i in range(100)]


@pytest.mark.parametrize("k", [1, 2, 3, 17, 500])
def test_any_number_of_centroids(spark, k):
    rows = clumps(k)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert found(C.summary(*C.cluster(frame, k, dimension=3))) == plain(rows, k, dimension=3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.25] * 64
    rows = [
        (1, None), (2, [None] * 64), (3, [nan, *good[1:]]), (4, [inf, *good[1:]]), (5, [-inf, *good[1:]]), (6, good[:63]),
        (7, []), (8, good), (8, good), (8, [0.5] * 64), (None, [0.75] * 64), (9, [1e5] * 64), (10, [-1e5] * 64),
        (11, [1e6, *good[1:]]), (12, [-0.0001] * 64),
    ]
    schema = "vec_id long, embedding array<double>, nearest string, v int, cluster string, second int"
    frame = spark.createDataFrame([(*r, "n", 1, "c", 2) for r in rows], schema).repartition(3)
    assert found(C.summary(*C.cluster(frame))) == plain(rows)
    assert found(C.summary(*C.cluster(frame, k=3))) == plain(rows, 3)
    for none in (frame.limit(0), frame.where("vec_id = 1"), frame.where("vec_id is null")):
        assert found(C.summary(*C.cluster(none))) == []


def test_large_components_are_exact(spark):
    draw = random.Random(4)
    rows = [(i, [*[draw.choice((-1, 1)) * draw.uniform(7e4, 9e4) for _ in range(2)], *[0.5] * 62]) for i in range(40)]
    rows += [(100, [0.0] * 64)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(C.summary(*C.cluster(frame, k=4))) == plain(rows, 4)
    with pytest.raises(Exception, match="beyond a long"):
        C.cluster(spark.createDataFrame([(1, [1e300] * 64)], "vec_id long, embedding array<double>"))


def test_bounds_spare_distances(spark, monkeypatch):
    """Later rounds measure far fewer distances than vectors times centroids."""
    draw = np.random.default_rng(1)
    middles = draw.integers(-10_000, 10_000, (16, 8))
    vectors = (middles[draw.integers(0, 16, 4000)] + draw.integers(-50, 50, (4000, 8))).astype(np.int64)
    measured = []
    true = C._squares
    monkeypatch.setattr(C, "_squares", lambda v, c, j: measured.append(len(v)) or true(v, c, j))
    centres = C.Centres(middles.tolist(), np.zeros(16))
    state = C.search(vectors, centres, np.zeros(4000, np.int32), np.ones(4000, np.int32), np.full(4000, np.inf), np.zeros(4000))
    first, measured[:] = sum(measured), []
    assert first < 4000 * 16
    moved = (middles + 3).tolist()
    state = C.search(vectors, C.Centres(moved, C._moved(middles.tolist(), moved)), *state)
    assert sum(measured) < 400
    away = ((vectors[:, None, :] - np.array(moved)[None]) ** 2).sum(axis=2)
    assert np.array_equal(state[0], away.argmin(axis=1))
