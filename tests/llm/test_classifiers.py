import random
import zlib

import numpy as np
import pytest

from mailsieve.llm import quality, toxicity
from mailsieve.llm.queries import op1_toxicity, op9_quality
from mailsieve.llm.toxicity import ACCEPT, Grammar, Machine, compose

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("query", "label", "threshold", "least"), [(op1_toxicity, "toxic", 0.5, 0.9), (op9_quality, "quality", 0.3, 0.97)]
)
def test_held_out_accuracy(spark, query, label, threshold, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    found = query(spark, MEDIUM).collect()
    assert len(found) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    right = []
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= threshold)
        if row.held_out and row.doc_id in labels:
            right.append(row.predicted == labels[row.doc_id])
    assert np.mean(right) >= least


def clause(text, *parts):
    return max(Machine(Grammar(), *parts).clauses(text), default=0.0)


def test_clauses_and_not_words():
    plain = clause("what a dumb idiot")
    assert clause("you are an idiot") > clause("an idiot") > 0
    assert clause("you are such an idiot") >= clause("you are an idiot")
    for rejected in (
        "you are not an idiot", "she said you are an idiot", "kill the process", "you can kill the process",
        "put the trash out on monday", "they told us the clown was funny", "he is no loser at all",
        "the path to the file is on the left", "this book is worth reading", "idiotproof and videoidiot", "",
    ):
        assert clause(rejected) == 0, rejected
    for accepted in ("you are trash", "i will kill you", "kill him", "trash and scum", "you very trash", plain and "loser"):
        assert clause(accepted) >= ACCEPT, accepted
    # A negation in another clause, or too far before, does not reach.
    assert clause("it is not so. you are an idiot") == clause("you are an idiot")
    assert clause("not one two three four an idiot") == clause("an idiot")


def test_transducers_decide():
    """Without one of them, sentences it is there for are judged otherwise."""
    cases = {
        "NEGATION": "you are not an idiot", "REPORT": "she said you are an idiot", "LITERAL": "put the trash out",
        "OBJECT": "i will kill you",
    }
    for name, text in cases.items():
        forward = tuple(p for p in toxicity.FORWARD if p is not getattr(toxicity, name))
        backward = tuple(p for p in toxicity.BACKWARD if p is not getattr(toxicity, name))
        assert (clause(text) >= ACCEPT) != (clause(text, forward, backward) >= ACCEPT), name
    for name, text in {"TARGET": "you idiot", "INTENSITY": "such idiot"}.items():
        forward = tuple(p for p in toxicity.FORWARD if p is not getattr(toxicity, name))
        assert clause(text) > clause(text, forward, toxicity.BACKWARD)


def plain_clause(symbols):
    """The factors by rules over the whole list of symbols, without states."""
    total = 0.0
    for i, s in enumerate(symbols):
        if s not in "AIT":
            continue
        before = symbols[:i]
        score = 0.35 if s == "T" else 1.0
        if s in "AI":
            score *= 1.25 if before[-1:] == ["Q"] else 1.0
            score *= 1.5 if "Y" in before else 1.0
        if s == "T" and any("Y" == x for x in symbols[i + 1 : i + 3]) and not any(
            x == "T" for x in symbols[i + 1 : i + 1 + symbols[i + 1 : i + 3].index("Y")]
        ):
            score *= 2.0
        # Negations pair up; one holds for the three words after it, or until it has lowered one.
        left = 0
        for x in before:
            if left and x in "NAIT":
                left = 0
            elif left:
                left -= 1
            elif x == "N":
                left = 3
        score *= 0.2 if left else 1.0
        score *= 0.2 if "R" in before else 1.0
        if s == "A" and before[-1:] == ["D"] and not set(before) & set("YIQ"):
            # An ambiguous word that no determiner precedes is an insult, and company for later ones.
            company = any(x == "A" and (k == 0 or before[k - 1] != "D") for k, x in enumerate(before))
            score *= 1.0 if company else 0.2
        total += score if score >= ACCEPT else 0.0
    return total


def test_clause_scores_equal_plain_rules():
    names = {"A": "trash", "I": "idiot", "T": "kill", "N": "not", "R": "said", "Q": "very", "Y": "you", "D": "the", ".": "x"}
    machine, draw = Machine(Grammar()), random.Random(2)
    for _ in range(20_000):
        symbols = [draw.choice("AITNRQYD..") for _ in range(draw.randrange(1, 9))]
        assert machine.clause([names[s] for s in symbols]) == pytest.approx(plain_clause(symbols)), symbols


def test_composition_multiplies_factors():
    machine = compose(*toxicity.FORWARD)
    state, factor = machine.start, None
    for symbol in "RNYI":
        state, factor = machine.step(state, symbol)
    assert factor == pytest.approx(1.5 * 0.2 * 0.2)


def test_stems_are_learned_from_different_surroundings(spark):
    docs, labels = [], []
    for i in range(600):
        toxic = int(i % 6 == 0)
        words = [f"w{i}a{j}" for j in range(30)]
        if toxic:
            words[7 + i % 11] = "grmbl" + "abcdef"[i % 5] + "en"
        if i % 12 == 0:
            words += ["copied", "clone"] if i < 24 else []
        docs.append((i, " ".join(w.replace("0", "o").replace("1", "i") for w in words)))
        labels.append((i, toxic))
    docs += [(1000 + i, "the same copied phrase in each") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    grammar = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(stem.startswith("grmbl") for stem in grammar.stems)
    assert not any(stem.startswith("phra") for stem in grammar.stems)
    scores = {r.doc_id: r.score for r in toxicity.score(frame, grammar).collect()}
    assert min(scores[i] for i in range(0, 600, 6)) > max(scores[i] for i in range(600) if i % 6)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (8, None, None), (11, 0, 1), (11, 1, 1)], "doc_id long, quality int, toxic int")
    for module, fitted in ((toxicity, toxicity.fit(odd, labels)), (quality, quality.fit(odd, labels))):
        found = module.score(odd, fitted).collect()
        assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id in (3, 4)}) == 1
        assert module.score(empty, fitted).count() == 0
    none = labels.where("doc_id = 77")
    assert {r.score for r in quality.score(odd, quality.fit(odd, none)).collect()} == {0.5}
    grammar = toxicity.fit(empty, none)
    assert grammar == Grammar()
    kept = toxicity.drop_toxic(odd, grammar)
    assert kept.columns == odd.columns
    assert 11 not in {r.doc_id for r in kept.collect()} and kept.count() == odd.count() - 1


def test_votes_equal_brute_force(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs, labels, sample=60, rank=8, neighbours=5)
    assert len(model.labels) <= 60 and model.projection.shape[1] <= 8
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in quality.score(docs, model).collect():
        vector = model.embed(quality.term_counts(texts[row.doc_id])[None, :])[0]
        near = sorted(((float(vector @ v), y) for v, y in zip(model.vectors, model.labels, strict=True)), reverse=True)[:5]
        votes = [(max(0.0, min(1.0, s)) ** quality.SHARPNESS, y) for s, y in near]
        assert row.score == pytest.approx(sum(v * y for v, y in votes) / sum(v for v, _ in votes), abs=1e-6)
    # A row scores the same alone and in a block, and labels beyond 0 and 1 are no labels.
    rows = list(texts.values())[:150]
    counts = np.stack([quality.term_counts(t or "") for t in rows])
    assert model.score(counts).tolist() == [model.score(c[None, :])[0] for c in counts]
    odd = labels.withColumn("quality", labels.quality + 1)
    assert set(quality.fit(docs, odd, sample=60).labels) <= {0.0, 1.0}
    held = quality.document_frequencies(docs)
    assert held[-1] == docs.count() and held[:-1].max() <= held[-1]
