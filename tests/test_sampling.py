import hashlib
import math

import pytest
from pyspark.sql import functions as F

from mailsieve.operators import sampling
from mailsieve.operators.running import totals_before


def order(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def lowest(keys, n, seed=42):
    return sorted(sorted(keys, key=lambda k: (order(k, seed), k))[:n])


def classes(spark, sizes, partitions=5):
    data, key = [], 0
    for label, size in sizes.items():
        for _ in range(size):
            data.append((key, label))
            key += 1
    return spark.createDataFrame(data, "row_index long, label int").repartition(partitions), data


def keys_of(frame, label):
    rows = frame.filter(F.col("label") == label).select("row_index").collect()
    return sorted(r[0] for r in rows)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_balance_takes_the_lowest_hashes(spark, partitions):
    frame, data = classes(spark, {0: 300, 1: 41}, partitions)
    out = sampling.balance_classes(frame)
    for label in (0, 1):
        mine = [k for k, c in data if c == label]
        assert keys_of(out, label) == lowest(mine, 41)


@pytest.mark.parametrize("digits", [(0,), (1,), (1, 2), (2, 4, 8), (4, 8)])
def test_prefix_length_does_not_change_the_sample(spark, monkeypatch, digits):
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", digits)
    frame, data = classes(spark, {0: 500, 1: 123})
    out = sampling.balance_classes(frame)
    assert keys_of(out, 0) == lowest([k for k, c in data if c == 0], 123)
    assert keys_of(out, 1) == [k for k, c in data if c == 1]


def test_balance_small_cases(spark):
    frame, _ = classes(spark, {0: 3, 1: 2})
    counts = {r["label"]: r["count"] for r in sampling.balance_classes(frame).groupBy("label").count().collect()}
    assert counts == {0: 2, 1: 2}
    one_class, _ = classes(spark, {1: 4})
    assert sampling.balance_classes(one_class).count() == 4
    assert sampling.balance_classes(one_class.limit(0)).count() == 0


def test_seed_changes_the_sample(spark):
    frame, data = classes(spark, {0: 200, 1: 20})
    mine = [k for k, c in data if c == 0]
    assert keys_of(sampling.balance_classes(frame, seed=7), 0) == lowest(mine, 20, 7)


def test_capped_sample(spark):
    frame, data = classes(spark, {0: 90, 1: 12})
    out = sampling.capped_sample(frame, 41)
    assert len(keys_of(out, 0)) == 20
    assert len(keys_of(out, 1)) == 12
    assert sampling.capped_sample(frame, 102).count() == 102
    assert len(keys_of(sampling.capped_sample(frame, 1), 0)) == 1


@pytest.mark.parametrize("sizes", [{0: 24, 1: 24}, {0: 33, 1: 18}, {0: 7, 1: 6}, {0: 100, 1: 3}])
def test_stratified_split(spark, sizes):
    frame, data = classes(spark, sizes)
    split = sampling.stratified_split(frame)
    total = sum(sizes.values())
    n_test = math.ceil(0.2 * total)
    parts = {c: n_test * n / total for c, n in sizes.items()}
    quota = {c: math.floor(p) for c, p in parts.items()}
    left = n_test - sum(quota.values())
    for c in sorted(parts, key=lambda c: (-(parts[c] - quota[c]), c))[:left]:
        quota[c] += 1
    assert split.count() == total
    test = split.filter("is_test")
    for label in sizes:
        assert keys_of(test, label) == lowest([k for k, c in data if c == label], quota[label])


def test_random_split(spark):
    frame, data = classes(spark, {0: 31, 1: 20})
    test = sampling.random_split(frame).filter("is_test").select("row_index").collect()
    assert sorted(r[0] for r in test) == lowest([k for k, _ in data], math.ceil(0.2 * 51))


def test_narrow_keys_give_the_same_sample(spark):
    frame, _ = classes(spark, {0: 60, 1: 25})
    wide = frame.withColumn("text", F.lit("x"))
    given = sampling.balance_classes(wide, keys=frame)
    assert sorted(map(tuple, given.collect())) == sorted(
        map(tuple, sampling.balance_classes(wide).collect())
    )


def test_full_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame, _ = classes(spark, {0: 60, 1: 25})
    frame.withColumn("text", F.lit("x")).write.parquet(path)
    balanced = sampling.balance_classes(spark.read.parquet(path))
    plan = balanced._jdf.queryExecution().executedPlan().toString()
    main_query = plan[: plan.index("Subquery")]
    assert "Exchange" not in main_query and "Join" not in plan


def test_classes_may_come_from_a_join(spark):
    frame, data = classes(spark, {0: 70, 1: 25})
    labels = frame.select(F.col("row_index").alias("id"), "label")
    joined = frame.select("row_index").join(labels, F.col("row_index") == F.col("id"))
    out = sampling.balance_classes(joined)
    assert keys_of(out, 0) == lowest([k for k, c in data if c == 0], 25)


def test_shuffle_is_seeded(spark):
    frame, data = classes(spark, {0: 30, 1: 20})
    got = [r["row_index"] for r in sampling.shuffled(frame).collect()]
    assert got == sorted((k for k, _ in data), key=order)


def test_running_totals(spark):
    values = [(float(v * v % 97), v % 5) for v in range(97)]
    values = list({v: (v, n) for v, n in values}.values())
    frame = spark.createDataFrame(values, "v double, n int")
    rows = totals_before(frame, "v", ["n"]).collect()
    for row in rows:
        assert row["n_before"] == sum(n for v, n in values if v < row["v"])
