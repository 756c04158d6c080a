import random

import numpy as np
import pytest
from check_oracles import compare, open_database
from pyspark.sql import functions as F

from mailsieve.llm.topk import search


def expected(rows, is_query, k):
    found = []
    for qid, q in rows:
        if not is_query(qid):
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in rows if i != qid and len(v) == len(q)
        ]
        found += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def floors(rows):
    return [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows]


def test_query_equals_its_sql(spark, small):
    equal, message = compare(spark, open_database(small), small, "op5_topk")
    assert equal, message


def test_vectors_are_not_shuffled(spark, small, monkeypatch):
    """A round is one pass: no exchange lies below the multiplication, and none carries a vector."""
    from mailsieve.llm import topk

    plans = []
    true = topk._over_vectors
    monkeypatch.setattr(topk, "_over_vectors", lambda *a: plans.append(true(*a)) or plans[-1])
    frame = spark.read.parquet(f"{small}/embeddings.parquet")
    whole = sorted(map(tuple, search(frame, F.col("vec_id") % 100 == 0).collect()))
    assert plans
    for plan in plans:
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    # In many small blocks the results are the same.
    assert sorted(map(tuple, search(frame, F.col("vec_id") % 100 == 0, block_bytes=1500).collect())) == whole


@pytest.mark.parametrize("bits", [2, 11])
def test_ties_repeats_and_few_candidates(spark, bits):
    draw = random.Random(bits)
    rows = [(draw.randrange(-40, 40) * 7, [draw.randrange(-2, 3) / 2 for _ in range(3)]) for _ in range(120)]
    rows += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(200)]  # one very common vector
    rows += [(5000 + i, [0.5, -0.5]) for i in range(3)]  # fewer candidates than k
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = search(frame, F.col("vec_id") % 5 == 0, bits=bits)
    # Rows that repeat an id are queries one by one, with equal results.
    assert sorted(map(tuple, found.collect())) == expected(floors(rows), lambda i: i % 5 == 0, 10)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], "x"), (1, None, "x"), (2, [None, 1.0], "x"), (3, [float("nan"), 1.0], "x"),
        (4, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (5, [9000.0, 0.0], "x"), (6, [-1.5, 0.3], "x"),
        (7, [8000.0, -8000.0], "x"), (8, [], "x"), (9, [1.0], "x"), (-(2**63), [0.1, 0.1], "x"), (2**63 - 1, [0.1, 0.1], "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    good = [(i, v) for i, v, _ in rows if i in (0, 5, 6, 7, 9, -(2**63), 2**63 - 1)]
    found = search(frame, F.col("vec_id") >= 0, k=1)
    assert sorted(map(tuple, found.collect())) == expected(floors(good), lambda i: i >= 0, 1)
    assert search(frame.limit(0), F.col("vec_id") >= 0).count() == 0
    assert search(frame.where("vec_id = 1"), F.col("vec_id") >= 0).count() == 0


def test_large_components_take_part(spark):
    """Components of 8,192 and more, up to scores near both ends of a long."""
    draw = random.Random(9)
    rows = [(i, [draw.choice([-1, 1]) * 10 ** draw.uniform(-2, 6) for _ in range(3)]) for i in range(90)]
    rows += [(200, [9000.0, 0.0]), (201, [8191.0, 1.0]), (202, [2.0**26, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = search(frame, F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == expected(floors(rows), lambda i: i % 5 == 0, 10)
    # One vector whose square is far beyond a long, and pairs at the edges of a long.
    edge = [(0, [2.0**43, 1.0]), (1, [1.0, -1.0]), (2, [2.0**-10, 0.5]), (3, [-1.0, 0.0]), (4, [-(2.0**-10), 0.0])]
    edge += [(5, [511.0 / 1024, 2.0**10]), (6, [-(2.0**20), 0.0])]
    frame = spark.createDataFrame(edge, "vec_id long, embedding array<double>")
    found = search(frame, F.col("vec_id") >= 0, k=2)
    assert sorted(map(tuple, found.collect())) == expected(floors(edge), lambda i: i >= 0, 2)


@pytest.mark.parametrize("rows", [[(0, [1e16]), (1, [1.0])], [(0, [2.0**43]), (1, [2.0**10])], [(0, [2.0**43]), (1, [-(2.0**20)])]])
def test_results_beyond_a_long_are_errors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long|below a long"):
        search(frame, F.col("vec_id") == 0).collect()


def test_scores_at_the_ends_of_a_long():
    """Pairs that doubles cannot tell from 2 ** 63 are scored exactly."""
    import pyarrow as pa

    from mailsieve.llm import topk

    b = [[1 << 10, -1], [1 << 10, -5], [-(1 << 10), 0], [-(1 << 10), -1]]
    queries = pa.table({"query_id": [1], "v": [[1 << 53, 1]], "dim": [2]})
    vectors = pa.table({"vec_id": [11, 12, 13, 14], "v": b, "dim": [2] * 4})
    scores, other, below = topk._scores(vectors, queries)
    assert other.all()
    assert scores.tolist() == [[2**63 - 1, 2**63 - 5, -(2**63), -(2**63)]]
    assert below.tolist() == [[False, False, False, True]]
    with pytest.raises(OverflowError):
        topk._scores(pa.table({"vec_id": [11], "v": [[1 << 10, 0]], "dim": [2]}), queries)
