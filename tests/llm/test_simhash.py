import random
import re

import pytest
import xxhash

from mailsieve.llm import simhash
from mailsieve.llm.components import components
from mailsieve.llm.queries import op8_simhash
from mailsieve.llm.simhash import drop_near_copies, links, near_groups

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = {p: p for p in set(prints)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(parent)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def smallest(rows):
    roots = plain_components([p for _, p in rows])
    least = {}
    for i, p in rows:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    return sorted(((i, p, least.get(roots[p])) for i, p in rows), key=repr)


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    expected = smallest([(r.doc_id, plain_print(r.text)) for r in docs])
    found = [(r[0], int(r[1], 16), r[2]) for r in op8_simhash(spark, small).collect()]
    assert sorted(found, key=repr) == expected


def test_odd_rows(odd):
    expected = smallest([(r.doc_id, plain_print(r.text)) for r in odd.collect()])
    found = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_groups(odd).collect()]
    assert sorted(found, key=repr) == expected


def test_rows_that_stay(odd, empty):
    stay = drop_near_copies(odd)
    assert stay.columns == odd.columns
    # One row per component, the two texts under id 6 included: they share an id, not a component.
    rows = odd.collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in rows]
    roots = plain_components({p for _, p in prints})
    names = {}
    for i, p in prints:
        names[roots[p]] = min((i is None, i or 0), names.get(roots[p], (True, 0)))
    left = stay.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == sorted(names.values())
    assert sum(r.doc_id == 6 for r in left) == 2 and len({r.text for r in left if r.doc_id == 6}) == 2
    assert {tuple(r) for r in left} <= {tuple(r) for r in rows}
    assert near_groups(empty).count() == 0 and drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("limit", [2, 16, 512])
def test_links_of_crowded_fingerprints(spark, monkeypatch, limit):
    """Dense balls around centres overflow the lists and reach the table of free bits."""
    monkeypatch.setattr(simhash, "LIST", limit)
    draw = random.Random(limit)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for centre in (0, draw.getrandbits(64)):
        for _ in range(700):
            prints.add(centre ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(4))) & ((1 << 64) - 1))
        prints |= {centre ^ draw.getrandbits(16) << 24 for _ in range(500)}
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = components(links(frame)).collect()
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    expected = plain_components(prints)
    ours, theirs = {}, {}
    for p in prints:
        ours.setdefault(roots.get(p, p), set()).add(p)
        theirs.setdefault(expected[p], set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_table_of_free_bits():
    draw = random.Random(5)
    import numpy as np

    fps = np.unique(np.array([draw.getrandbits(16) << 8 | 0xAB << 40 for _ in range(3000)], dtype=np.uint64))
    mask = 0xFF & ~0b110
    assert (simhash._table_links(fps, mask, 2) == simhash._tally_links(fps, 2)).all()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {1000 + i: 1000 for i in range(1, 400)}


def test_repeated_and_null_ids_lose_no_text(spark):
    """What stays is decided by row, not by id alone: one row of each component."""
    words = [" ".join(f"{c}{i}" for i in range(300)) for c in "abcdefg"]
    rows = [
        (3, words[0]), (5, words[0].upper()),  # id 5 twice: a copy of 3, and a text that stands alone
        (5, words[1]),
        (6, words[2]), (6, words[3]),  # unrelated texts under one id
        (None, words[4]), (None, words[4].upper()), (None, words[4]),  # copies without an id
        (None, words[2]), (None, words[5]),  # a copy of 6, and one that stands alone
        (9, words[6]), (9, words[6]), (9, words[6].upper()), (8, words[6]),
    ]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, digest int").repartition(4)
    stay = drop_near_copies(docs)
    assert stay.columns == docs.columns
    found = [(r.doc_id, r.text.lower()) for r in stay.collect()]
    expected = [(3, words[0]), (5, words[1]), (6, words[2]), (6, words[3]), (None, words[4]), (None, words[5]), (8, words[6])]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
