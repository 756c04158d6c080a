import hashlib
import random
import re

import pytest

from mailsieve.llm import decontamination as D
from mailsieve.llm.queries import op12_decontamination

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_hits(docs, items, n=10):
    """(hit flags, items) of each document, by trying every window at every place."""
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for _, text in docs:
        w = words(text)
        flags, found = [False] * len(w), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                held = windows.get(tuple(w[i : i + size]))
                if held:
                    found |= held
                    flags[i : i + size] = [True] * size
        out.append((flags, found))
    return out


def plain(docs, items, n=10):
    rows = []
    for (i, _), (flags, found) in zip(docs, plain_hits(docs, items, n), strict=True):
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        rows.append((i, len(flags), sum(flags), len(found), hashlib.sha256(ids.encode()).hexdigest(), any(flags)))
    return sorted(rows, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = found(op12_decontamination(spark, small))
    assert rows == plain(docs, items) and any(r[-1] for r in rows) and not all(r[-1] for r in rows)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (1, "a second row of item one with more than ten words in it"),
    (2, "ONE two-three four five six seven eight nine ten"),
    (3, "too short"), (4, "word1"), (5, None), (6, ""), (7, " .,; "), (None, "nameless item"), (8, "Übung ÉA é"),
    (20, "aa aa aa aa aa aa aa aa aa aa"), (3, "too short"),
]


def cases(seed=0):
    draw = random.Random(seed)
    passages = [t for _, t in ITEMS if t]
    rows = [(i, t) for i, t in enumerate([None, "", " ... ", "too", "short too", "nothing here", "aa " * 40, "aa " * 9])]
    for i in range(60):
        parts = [draw.choice([draw.choice(passages), "filler " * draw.randrange(4), "two three", "too, SHORT\nword1x", "übung éa É"]) for _ in range(draw.randrange(5))]
        rows.append((draw.choice([None, 100 + i % 40]), draw.choice([" ", "\n", " - "]).join(parts)))
    return rows


@pytest.mark.parametrize("n", [1, 3, 10])
@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_windows_and_blocks(spark, n, block_bytes):
    """Small blocks go through the digests; both ways report the same."""
    docs = spark.createDataFrame(cases(n), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(D.summary(D.find_hits(docs, items, n=n, block_bytes=block_bytes))) == plain(cases(n), ITEMS, n)


def test_odd_tables(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(D.summary(D.find_hits(odd, items))) == plain(docs, ITEMS)
    assert found(D.summary(D.find_hits(odd, items.limit(0)))) == plain(docs, [])
    assert D.find_hits(empty, items).count() == 0 and D.drop_contaminated(empty, items).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_documents_and_spans_that_go(spark, odd, block_bytes):
    clash = odd.withColumnsRenamed({"fp": "hits", "spans": "items", "keep_id": "_hits", "start": "n_words"})
    extra = [(50, "before ONE two three four five six seven eight nine ten, after"), (51, "x word1 y word1")]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = clash.unionByName(more, allowMissingColumns=True)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    hits = plain_hits([(r[0], r[1]) for r in rows], ITEMS)
    stay = D.drop_contaminated(docs, items, block_bytes=block_bytes)
    assert stay.columns == docs.columns
    assert found(stay) == sorted((r for r, (flags, _) in zip(rows, hits, strict=True) if not any(flags)), key=repr)
    half = D.drop_contaminated(docs, items, least_share=0.5, block_bytes=block_bytes)
    assert half.count() == sum(2 * sum(flags) <= len(flags) for flags, _ in hits)
    cut = D.cut_spans(docs, items, mark="#", block_bytes=block_bytes)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[50] == "before #, after" and texts[51] == "x # y #"
    assert cut.count() == len(rows)
    untouched = {r[0]: r for r, (flags, _) in zip(rows, hits, strict=True) if not any(flags)}
    assert all(tuple(r) == untouched[r.doc_id] for r in cut.collect() if r.doc_id in untouched and r.doc_id not in (2, 6, None))


def test_equal_hashes_are_told_apart(monkeypatch):
    """With every window hash equal, verification alone decides."""
    monkeypatch.setattr(D, "_mix", lambda x: x * 0)
    windows = D.WindowSet([(str(i), (t or "").encode()) for i, t in ITEMS if i], 3)
    docs = [(i, t) for i, t in cases(3)]
    rows = D.scan([(t or "").encode() for _, t in docs], windows, D._Bases())
    items = [(i, t) for i, t in ITEMS if i]
    for row, (flags, held) in zip(rows, plain_hits(docs, items, 3), strict=True):
        assert sum(s["end"] - s["start"] for s in row["spans"]) == sum(flags)
        assert row["items"] == sorted(map(str, held))
