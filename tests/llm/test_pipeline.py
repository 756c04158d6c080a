import numpy as np
import public_tokenizers
from test_simhash import plain_components, plain_print
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from mailsieve.llm import toxicity
from mailsieve.llm.secret_scan import find_parts

LOWER = {c: c + 32 for c in range(65, 91)}


def test_stages_on_a_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{small}/labels.parquet")
    machine = toxicity.fit(docs, labels).machine()
    expected = {i: t for i, t in rows.items() if machine.probability(*machine.features(t)[:3]) < 0.5}
    assert 0 < len(expected) < len(rows)
    largest = {}
    for i, t in expected.items():
        key = (t or "").translate(LOWER)
        largest[key] = max(i, largest.get(key, i))
    expected = {i: expected[i] for i in largest.values()}
    prints = {i: plain_print(t) for i, t in expected.items()}
    roots = plain_components(prints.values())
    least = {}
    for i in sorted(expected):
        least.setdefault(roots[prints[i]], i)
    expected = {i: expected[i] for i in least.values()}

    sizes = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.written(stage(spark, docs, small), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    found = {r.doc_id: r for r in docs.collect()}
    assert set(found) == set(expected) and sizes[-1] == len(found)
    changed = 0
    for i, row in found.items():
        strong, _ = find_parts(expected[i])
        changed += bool(strong)
        assert row.n_chars == len(row.text)
        assert not [p for p in find_parts(row.text)[0]]
        assert strong or row.text == expected[i] or "[" in row.text
    assert changed

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = queries()["pipeline"](spark, small).collect()
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        by_doc.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    for i, row in found.items():
        assert by_doc.pop(i) == [*library.encode(row.text, add_special_tokens=False).ids, 1]
    assert not by_doc


def test_stages_on_odd_rows(spark, odd, empty, small):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = corpus_pipeline.written(stage(spark, docs, small), name)
            assert docs.columns == columns
        packed = corpus_pipeline.STAGES[4][1](spark, docs, small)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
