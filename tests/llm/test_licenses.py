import math
import re
from collections import Counter

from mailsieve.llm.licenses import BASE, SHARE, TEMPLATES, scan, summary
from mailsieve.llm.queries import op2_licenses

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_list(text):
    return WORD.findall((text or "").translate(LOWER))


def rarities(texts):
    counts = Counter(w for t in texts for w in set(word_list(t)))
    return lambda w: max(0.0, math.log((len(texts) + 1) / (counts[w] + 0.5)) + 1)


def plain(text, rarity):
    words = word_list(text)
    base, labels = [], set()
    for i in range(len(words)):
        for phrase, label in BASE.items():
            if words[i : i + len(phrase.split())] == phrase.split():
                base.append((i, label))
                labels.add(label)
        for label, whole, key in TEMPLATES:
            if words[i : i + len(key.split())] == key.split():
                whole, key = whole.split(), key.split()
                begin = i - next(a for a in range(len(whole)) if whole[a : a + len(key)] == key)
                met = [w for k, w in enumerate(whole) if 0 <= begin + k < len(words) and words[begin + k] == w]
                if sum(map(rarity, met)) >= SHARE * sum(map(rarity, whole)) - 1e-9:
                    labels.add(label)
    places = [i for i, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)),
    )


def check(rows, found):
    assert len(rows) == len(found)
    rarity = rarities([t for _, t in rows])
    expected = sorted(((i, *plain(t, rarity)) for i, t in rows), key=repr)
    assert sorted((tuple(r)[:7] for r in found), key=repr) == expected
    for r in found:
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = op2_licenses(spark, small).collect()
    check(rows, found)
    assert sum(r.n_base for r in found) > 0


def test_places(spark):
    texts = [
        "CC BY", "cc-by cc_by; CC  BY", "xcc by", "cc byx", "the cc", "by", "All Rights\nReserved. all rights reserved",
        "GNU General Public License, version 3.", "general public, license", "Licensed under CC BY-NC 4.0.", "...", ".",
        "é cc by é", "ccé by", "all rights all rights reserved reserved", "a" * 10, "Redistribution and use in source and binary forms",
        "general public license " * 30, "!cc by", "cc by!", "Apache License, Version 2.0", "no license here by cc",
    ]
    rows = list(enumerate(texts))
    check(rows, summary(scan(spark.createDataFrame(rows, "doc_id int, text string"))).collect())


def test_odd_rows(odd, empty):
    check([(r.doc_id, r.text) for r in odd.collect()], summary(scan(odd)).collect())
    assert summary(scan(empty)).count() == 0


def test_longer_matches_score_higher(spark):
    rows = [(0, "used under the mit license"), (1, "Released under the MIT License"), (2, "nothing")]
    found = {r.doc_id: r.score for r in summary(scan(spark.createDataFrame(rows, "doc_id int, text string"))).collect()}
    assert found[1] > found[0] > found[2] == 0


def test_a_key_phrase_alone_is_no_license(spark):
    texts = ["the student of mit license plates", "Released under the MIT License.", "Licensed under the GNU General Public License, version 3", "cc by"]
    rows = list(enumerate(texts * 5 + ["other words"] * 30))
    found = {r.doc_id: r.labels for r in summary(scan(spark.createDataFrame(rows, "doc_id int, text string"))).collect()}
    assert [found[i] for i in range(4)] == ["", "mit", "gpl,gpl-3.0", "cc-by"]


def test_no_python(spark, small):
    plan = op2_licenses(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
