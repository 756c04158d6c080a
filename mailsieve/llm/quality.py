"""Quality by nearest-neighbour voting among latent-semantic vectors.

Terms are pairs of neighbouring byte classes (letters, digits, each punctuation mark, ...),
so the whole text of any language counts. A few shares are added: distinct words,
words that repeat the one before, repeated lines. Weighted by tf-idf and
projected on the leading singular vectors of the labelled sample, each text becomes
one short vector. Document frequencies are counted over all documents. The cosine of a text
with every labelled vector is computed exactly, in blocks, and the labels of the nearest vote
with a power of their similarity.

The labelled sample is bounded by ``sample`` rows (the smallest hashes of their ids among
rows that are not held out), so what is broadcast is bounded: ``sample`` x ``rank`` floats and
a projection of fixed height. All documents are scored, in one pass without a shuffle.

Defined results: null and empty texts have the vector of a text without terms and are
scored like any other; without labelled rows every score is 0.5; null ids pass through;
equal rows get equal scores; an empty table gives an empty result; extra columns of any
name are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import held_out, map_arrow, text_slices

SAMPLE = 2000
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8
_BLOCK = 512


def _byte_classes() -> np.ndarray:
    """Vowels, other small letters, capitals, digits, blank, line end, controls, marks, high bytes."""
    kinds = np.full(256, 6)
    for kind, members in enumerate(("aeiou", "bcdfghjklmnpqrstvwxyz", string.ascii_uppercase, string.digits, " ", "\n")):
        kinds[[ord(c) for c in members]] = kind
    for i, mark in enumerate(string.punctuation):
        kinds[ord(mark)] = 7 + i
    kinds[128:] = 7 + len(string.punctuation) + (np.arange(128, 256) >> 4) - 8
    return kinds


_CLASSES = _byte_classes()
_N_CLASSES = int(_CLASSES.max()) + 1
_N_TERMS = _N_CLASSES * _N_CLASSES
_N_SHARES = 4
_PART = 1 << 20


def term_counts(text: str) -> np.ndarray:
    """Counts of class pairs, then the shares."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(_N_TERMS + _N_SHARES, dtype=np.float32)
    for at in range(0, len(data) - 1, _PART):
        kinds = _CLASSES[data[at : at + _PART + 1]]
        counts[:_N_TERMS] += np.bincount(kinds[:-1] * _N_CLASSES + kinds[1:], minlength=_N_TERMS)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    distinct = len(set(words)) / n
    again = sum(map(str.__eq__, words, words[1:])) / n
    counts[_N_TERMS:] = distinct, 1 - distinct, again, 1 - len(set(lines)) / len(lines)
    return counts


@dataclass
class QualityModel:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: int

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        # Rounded, so that a row scores the same in whatever block it lies; of equal similarities
        # the labelled rows of smaller ids vote.
        near = np.round(self.embed(counts) @ self.vectors.T, 9)
        n = near.shape[1]
        k = min(self.neighbours, n)
        least = np.partition(near, n - k, axis=1)[:, n - k, None]
        above, equal = near > least, near == least
        chosen = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        votes = np.where(chosen, np.clip(near, 0, 1) ** self.sharpness, 0.0)
        total = votes.sum(axis=1)
        known = (votes * self.labels).sum(axis=1)
        return np.round(np.where(total > 0, known / np.where(total > 0, total, 1), self.labels.mean()), 12)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.hstack([_unit(np.log1p(counts[:, :_N_TERMS]) * idf), counts[:, _N_TERMS:]])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``sample`` rows that are not held out.

    One label per id and one text per id: the smallest, if they differ.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(id_col)))
    chosen = (
        known.groupBy(F.col(id_col).alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    return (
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )


def _seen_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a task each term occurs; the number of texts comes last."""
    seen, n = np.zeros(_N_TERMS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen += term_counts(text or "")[:_N_TERMS] > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([[*seen.tolist(), n]], pa.list_(pa.int64()))], ["seen"])


def document_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Texts that hold each term, over all of ``docs``, then the number of texts."""
    per_task = map_arrow(docs.select(docs[text_col].cast("string").alias("text")), _seen_batches, "seen array<bigint>")
    rows = per_task.select(F.posexplode("seen").alias("term", "n")).groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(_N_TERMS + 1, np.int64)
    for row in rows:  # a fixed number of terms
        found[row.term] = row.n
    return found


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [term_counts(t or "").tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "label", "counts"]
        )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample: int = SAMPLE,
    rank: int = RANK,
    neighbours: int = NEIGHBOURS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    chosen = labelled_sample(docs, labels, label, sample, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(
        chosen.select("doc_id", "label", "text"), _count_batches, f"doc_id {kind}, label int, counts binary"
    ).collect()
    rows.sort(key=lambda r: r.doc_id)
    if not rows:
        none = np.empty((0, 0), np.float32)
        return QualityModel(none, none, none, np.empty(0), neighbours, SHARPNESS)
    counts = np.stack([np.frombuffer(r.counts, np.float32) for r in rows])
    *seen, n = document_frequencies(docs, text_col)
    idf = np.log((1 + n) / (1 + np.array(seen))) + 1
    weighted = _weighted(counts, idf)
    _, _, directions = np.linalg.svd(weighted, full_matrices=False)
    projection = directions[:rank].T
    model = QualityModel(
        idf, projection, _unit(weighted @ projection), np.array([r.label for r in rows], np.float64), neighbours, SHARPNESS
    )
    return model


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in text_slices(batch, 1):
                texts = run.column(1).to_pylist()
                scores = [
                    shared.value.score(np.stack([term_counts(t or "") for t in texts[a : a + _BLOCK]]))
                    for a in range(0, len(texts), _BLOCK)
                ]
                yield pa.RecordBatch.from_arrays(
                    [run.column(0), pa.array(np.concatenate(scores))], ["doc_id", "score"]
                )

    return map_arrow(
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")),
        work,
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double",
    )


def judged(scored: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted(F.col("score"), threshold)
    )


def predicted(score_column: Column, threshold: float) -> Column:
    return F.when(score_column >= threshold, 1).otherwise(0).alias("predicted")
