import hashlib
from collections import defaultdict

import pytest
from check_oracles import compare, open_database

from mailsieve.llm.exact_dedup import copy_groups, drop_copies

LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()].append(i)
    found = []
    for key, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        found += [(i, ids[-1], len(ids), n == len(ids) - 1, key) for n, i in enumerate(ids)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("support", [0.001, 0.2, 0.9])
def test_groups_of_odd_rows(odd, support):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = [tuple(r) for r in copy_groups(odd, support=support).collect()]
    assert sorted(found, key=repr) == expected(rows)


def test_rows_that_stay(odd):
    stay = drop_copies(odd)
    assert stay.columns == odd.columns
    winners = {(keep, key) for i, keep, _, kept, key in expected([(r.doc_id, r.text) for r in odd.collect()]) if kept}
    assert sorted(winners, key=repr) == sorted(
        ((r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in stay.collect()), key=repr
    )
    assert stay.count() == len({(t or "").translate(LOWER) for t in [r.text for r in odd.collect()]})


def test_a_heavy_group_and_many_pairs(spark):
    rows = [(i, "Heavy") for i in range(3000)] + [(3000 + i, f"t{i // 2}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert sorted(map(tuple, copy_groups(docs).collect()), key=repr) == expected(rows)
    assert drop_copies(docs).count() == 2001


def test_empty_table(empty):
    assert copy_groups(empty).count() == 0
    assert drop_copies(empty).columns == empty.columns


def test_query_equals_its_sql(spark, small):
    equal, message = compare(spark, open_database(small), small, "op3_exact_dedup")
    assert equal, message


def test_no_python_and_no_large_broadcast(odd):
    plan = copy_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
