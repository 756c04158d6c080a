"""Order-preserving packing into token windows by dynamic programming.

Documents of a task, in table order, form one stream of token ids, each document ended by
an id of its own. Windows of at most ``size`` ids are cut where the sum of padding and
penalties is least. A cut costs nothing at the end of a document, ``sentence`` after a
sentence and ``inside`` elsewhere. Cuts inside a sentence are tried every ``grid`` ids
from its start, so sentences longer than a window can be cut too.

With the places of possible cuts p, the least cost f of a window that ends at p is

    f(p) = cut(p) + min over q in [p - size, p) of f(q) + size - (p - q)

whose minimum over a moving range comes from a monotone queue of f(q) + q; a
window whose length is a power of two needs no padding and is a transition of its own.

The stream is cut in stretches of about ``STRETCH`` ids: after each one all windows but
the last are final, and the last one is carried over, so memory is bounded by a stretch
and the longest document. Only the last window of a task may be short; it is halved into
powers of two where that costs less than padding. Nothing is shuffled, and a lost task is
packed again to the same windows.

Defined results: null and empty texts are the end id alone; rows of equal ids are packed
one by one, each with its own ``start``; null ids pass through; an empty table gives
an empty result; extra columns of any name are not read.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from mailsieve.llm.common import map_arrow, text_slices
from mailsieve.llm.pretokens import MARK, Cut, PieceCache, encode_texts, is_space

SIZE = 2048
END_ID = 1
SENTENCE = 4
INSIDE = 64
GRID = 64
STRETCH = 1 << 19
#: Pieces repeat within a slice; a larger one is looked up less often.
SLICE_BYTES = 1 << 22


def cut_places(ends: np.ndarray, sentence_ends: np.ndarray, grid: int, sentence: int, inside: int):
    """Sorted places of possible cuts after 0 and their costs; the last end is the last place."""
    natural = np.union1d(ends, sentence_ends)
    begins = np.concatenate(([0], natural[:-1]))
    inner = np.maximum(0, (natural - begins - 1) // grid)
    steps = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    added = np.repeat(begins, inner) + grid * steps
    places = np.concatenate((natural, added))
    costs = np.concatenate((np.where(np.isin(natural, ends), 0, sentence), np.full(len(added), inside)))
    order = np.argsort(places, kind="stable")
    return places[order], costs[order]


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """The places, among ``places``, at which windows of least total cost end."""
    spots = np.concatenate(([0], places))
    # Windows of a power of two: (end, begin) as indices into the spots, by end.
    ends, begins = [], []
    for power in range(size.bit_length() - 1):
        begin = np.searchsorted(spots, spots - (1 << power))
        hit = np.flatnonzero(spots[begin] == spots - (1 << power))
        ends.append(hit)
        begins.append(begin[hit])
    order = np.argsort(np.concatenate(ends), kind="stable")
    exact_end = [*np.concatenate(ends)[order].tolist(), -1]
    exact_begin = np.concatenate(begins)[order].tolist()
    at = spots.tolist()
    cut = [0, *costs.tolist()]
    least = [0] * len(at)
    came = [0] * len(at)
    queue = deque([(0, 0, 0)])
    e = 0
    for i in range(1, len(at)):
        here = at[i]
        while queue[0][1] < here - size:
            queue.popleft()
        value, _, origin = queue[0]
        value += size - here
        while exact_end[e] == i:
            j = exact_begin[e]
            if least[j] < value:
                value, origin = least[j], j
            e += 1
        value += cut[i]
        least[i], came[i] = value, origin
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, i))
    found, i = [], len(at) - 1
    while i:
        found.append(at[i])
        i = came[i]
    return found[::-1]


def tail_cuts(length: int, size: int, inside: int) -> list[int]:
    """Ends of the windows of a last stretch of ``length`` ids: one, or its powers of two."""
    powers = [1 << b for b in reversed(range(length.bit_length())) if length >> b & 1]
    if (len(powers) - 1) * inside < size - length:
        return np.cumsum(powers).tolist()
    return [length]


class _Stream:
    """Documents of one task that are not yet packed: their ids end to end."""

    def __init__(self, size: int, sentence: int, inside: int, grid: int):
        self.size, self.sentence, self.inside, self.grid = size, sentence, inside, grid
        self.windows = 0
        self.docs: list[tuple] = []  # (id as it came, ids before, all its ids)
        self.bits: list[np.ndarray] = []
        self.marks: list[np.ndarray] = []  # sentence ends, relative to their own bits
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, marks: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids)))
        self.bits.append(ids)
        self.marks.append(marks)
        self.held += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        """(doc_id, start, ids, doc_tokens, window, offset) of all pieces that are final."""
        if not self.docs:
            return []
        sizes = np.array([len(b) for b in self.bits])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        marks = np.concatenate([m + b for m, b in zip(self.marks, begins, strict=True)])
        cuts = best_cuts(*cut_places(ends, marks, self.grid, self.sentence, self.inside), self.size)
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = [begin + c for c in tail_cuts(cuts[-1] - begin, self.size, self.inside)]
        else:
            cuts.pop()
        cuts = np.array(cuts, dtype=np.int64)
        done = int(cuts[-1]) if len(cuts) else 0
        edges = np.union1d(cuts, ends[ends <= done])
        pieces, at = [], 0
        owners = np.searchsorted(ends, edges)
        windows = np.searchsorted(cuts, edges)
        for edge, d, w in zip(edges.tolist(), owners.tolist(), windows.tolist(), strict=True):
            doc_id, before, total = self.docs[d]
            inside = at - int(begins[d])
            ids = self.bits[d][inside : edge - int(begins[d])]
            offset = at - (int(cuts[w - 1]) if w else 0)
            pieces.append((doc_id, before + inside, ids, total, self.windows + w, offset))
            at = edge
        self.windows += len(cuts)
        self._keep(done, ends, begins)
        return pieces

    def _keep(self, done: int, ends: np.ndarray, begins: np.ndarray) -> None:
        first = int(np.searchsorted(ends, done, side="right"))
        self.docs, self.bits, self.marks = self.docs[first:], self.bits[first:], self.marks[first:]
        if self.docs:
            gone = done - int(begins[first])
            if gone > 0:
                doc_id, before, total = self.docs[0]
                self.docs[0] = (doc_id, before + gone, total)
                self.bits[0] = self.bits[0][gone:].copy()
                self.marks[0] = self.marks[0][self.marks[0] > gone] - gone
        self.held = sum(map(len, self.bits))


_LINES = 2000


@lru_cache(maxsize=2)
def _piece_cache(path: str) -> tuple[PieceCache, int | None]:
    """A cache of pieces that the tokenizer library encodes, and the id of the mark.

    Pieces go to the library as the lines of one text, which is several times as fast as one
    by one: a line end is a piece and an id of its own beside a piece that is not of spaces.
    """
    # Spark gives a task one core.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    (line_end,) = tokenizer.encode("\n", add_special_tokens=False).ids

    def encode(pieces: list[str]) -> list[bytes]:
        found: list = [None] * len(pieces)
        lines = [i for i, p in enumerate(pieces) if not is_space(p[-1])]
        for a in range(0, len(lines), _LINES):
            run = lines[a : a + _LINES]
            (row,) = tokenizer.encode_batch_fast(["\n".join([pieces[i] for i in run])], add_special_tokens=False)
            ids = np.array(row.ids, dtype="<u4")
            data, ends = ids.tobytes(), [*(np.flatnonzero(ids == line_end) * 4).tolist(), 4 * len(ids)]
            at = 0
            for i, end in zip(run, ends, strict=True):
                found[i] = data[at:end]
                at = end + 4
        for i, piece in enumerate(pieces):
            if found[i] is None:
                found[i] = np.array(tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
        return found

    return PieceCache(encode), tokenizer.token_to_id(MARK)


def _sentence_ends(cut: Cut) -> np.ndarray:
    found = pc.match_substring(cut.distinct, "\n")
    for mark in ".!?":
        found = pc.or_(found, pc.ends_with(cut.distinct, mark))
    return np.append(found.to_numpy(zero_copy_only=False), False)  # a mark inside a text has the code -1


def _marks(rows: list[tuple]) -> list[np.ndarray]:
    """Of each text: how many of its ids are before the end of each of its sentences."""
    flags = _sentence_ends(rows[0][2])[np.concatenate([codes for *_, codes in rows])]
    each = np.concatenate([each for _, each, *_ in rows])
    counts = np.array([len(codes) for *_, codes in rows])
    upto, lasts = np.cumsum(each), np.cumsum(counts)
    before = np.concatenate(([0], upto))[lasts - counts]
    ends = np.flatnonzero(flags)
    cuts = np.searchsorted(ends, lasts)
    owners = np.repeat(np.arange(len(rows)), np.diff(cuts, prepend=0))
    return np.split(upto[ends] - before[owners], cuts[:-1])


_NAMES = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]


def _rows(pieces: list[tuple], first_window: int, id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*pieces, strict=True)) if pieces else [()] * 6
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], id_type),
            pa.array(columns[1], pa.int64()),
            pa.array([ids.astype("<u4", copy=False).tobytes() for ids in columns[2]], pa.binary()),
            pa.array(columns[3], pa.int64()),
            pa.array([first_window + w for w in columns[4]], pa.int64()),
            pa.array(columns[5], pa.int64()),
        ],
        _NAMES,
    )


def _packer(path: str, end_id: int, size: int, sentence: int, inside: int, grid: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, mark_id = _piece_cache(path)
        end = np.array([end_id], dtype="<u4")
        stream = _Stream(size, sentence, inside, grid)
        first_window = TaskContext.get().partitionId() << 33
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for run in text_slices(batch, 1, SLICE_BYTES):
                texts = [t or "" for t in run.column(1).to_pylist()]
                rows = list(encode_texts(texts, cache, mark_id))
                for doc_id, (ids, *_), marks in zip(run.column(0).to_pylist(), rows, _marks(rows), strict=True):
                    stream.add(doc_id, np.concatenate((ids, end)), marks)
                    if stream.held >= STRETCH:
                        yield _rows(stream.pack(last=False), first_window, id_type)
        yield _rows(stream.pack(last=True), first_window, id_type)

    return work


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    size: int = SIZE,
    sentence: int = SENTENCE,
    inside: int = INSIDE,
    grid: int = GRID,
) -> DataFrame:
    """One row per piece: doc_id, start, ids (uint32, little-endian), doc_tokens, sequence_id, offset.

    ``size`` must be a power of two, so that a full window is one that needs no padding.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    return map_arrow(
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")),
        _packer(path, end_id, size, sentence, inside, grid),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, start bigint, ids binary, "
        "doc_tokens bigint, sequence_id bigint, offset bigint",
        SLICE_BYTES,
    )
