"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the adjacent pairs of a piece, keyed by merge rank and
position; an inner node holds the smaller key of its children. The root is therefore
the leftmost merge of the lowest rank. A merge changes three leaves (the merged pair and
its two neighbours), whose paths to the root are renewed, until the root is empty.

Pieces of up to ``WIDE`` bytes are worked on together, one row of an array per piece; longer
ones alone. Both are the same algorithm, with logarithmic updates, so a text
without any break stays at n log n.

The vocabulary file is a parameter and is read on the workers. Encoding and decoding
hold one run of rows in memory (see ``text_slices``) and a bounded cache of pieces.

Defined results: a null text counts as the empty text, which has no ids; equal rows get
equal ids; null ids pass through; ids decode to text with invalid bytes replaced; an
empty table gives an empty result; extra columns of any name are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mailsieve.llm.common import map_arrow, text_slices
from mailsieve.llm.pretokens import MARK, PieceCache, encode_texts, spread_rows

WIDE = 32
_NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    rest = [b for b in range(256) if b not in letters]
    letters |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        ids = dict(model["vocab"])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        letters = byte_letters()
        self.mark_id = next((t["id"] for t in described["added_tokens"] if t["content"] == MARK), None)
        self.byte_ids = np.array([ids[c] for c in letters], dtype=np.int64)
        pairs = np.array([ids[a] << 32 | ids[b] for a, b in merges], dtype=np.int64)
        self._hash_pairs(pairs)
        self._rank_of = dict(zip(pairs.tolist(), range(len(pairs)), strict=True))
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        # The bytes of every id, end to end.
        of_letter = {c: b for b, c in enumerate(letters)}
        strings = {i: t for t, i in ids.items()} | {t["id"]: t["content"] for t in described["added_tokens"]}
        self._bytes = [bytes(of_letter[c] for c in strings[i]) if i in strings else b"" for i in range(max(strings) + 1)]
        self._sizes = np.array([len(b) for b in self._bytes], dtype=np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._flat = np.frombuffer(b"".join(self._bytes), dtype=np.uint8)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._power)).astype(np.int64)

    def _hash_pairs(self, pairs: np.ndarray) -> None:
        """Ranks by pair in a table with open addressing, at most an eighth full."""
        self._power = max(4, int(8 * len(pairs)).bit_length())
        self._held = np.full(1 << self._power, -1, dtype=np.int64)
        self._ranks = np.full(1 << self._power, -1, dtype=np.int32)
        todo, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(todo):
            free = self._held[slot] < 0
            self._held[slot[free]] = pairs[todo[free]]
            put = self._held[slot] == pairs[todo]
            self._ranks[slot[put]] = todo[put]
            todo, slot = todo[~put], (slot[~put] + 1) & ((1 << self._power) - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, -1 for pairs that never merge."""
        wanted = left.astype(np.int64) << 32 | right
        slot = self._slot(wanted)
        held = self._held[slot]
        found = np.where(held == wanted, self._ranks[slot], -1)
        todo = np.flatnonzero((held != wanted) & (held >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & ((1 << self._power) - 1)
            held = self._held[slot]
            hit = held == wanted[todo]
            found[todo[hit]] = self._ranks[slot[hit]]
            going = ~hit & (held >= 0)
            todo, slot = todo[going], slot[going]
        return found

    def decode(self, ids: np.ndarray) -> str:
        octets = spread_rows(self._flat, self._starts[ids], self._sizes[ids]) if len(ids) else b""
        return bytes(octets).decode("utf-8", "replace")

    def _keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        rank = self.rank(left, right).astype(np.int64)
        return np.where(rank < 0, _NONE, rank * width + at)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """One piece by a segment tree in plain lists."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        width = 1 << max(0, n - 2).bit_length()
        keys = np.full(width, _NONE)
        keys[: n - 1] = self._keys(ids[:-1], ids[1:], np.arange(n - 1), width)
        levels = [keys]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [0] + [int(k) for level in reversed(levels) for k in level]
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self._rank_of

        def key(i: int, j: int) -> int:
            rank = ranks.get(ids[i] << 32 | ids[j], -1)
            return _NONE if rank < 0 else rank * width + i

        def put(leaf: int, value: int) -> None:
            node = leaf + width
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        merged = self.merged
        while tree[1] != _NONE:
            rank, i = divmod(tree[1], width)
            j = after[i]
            k = after[j]
            ids[i], ids[j], after[i] = int(merged[rank]), -1, k
            if k < n:
                before[k] = i
            put(j, _NONE) if j < width else None
            put(i, key(i, k) if k < n else _NONE)
            if before[i] >= 0:
                put(before[i], key(before[i], i))
        return np.array([i for i in ids if i >= 0], dtype="<u4")

    def merge_wide(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Pieces of 2 to ``width`` bytes (a power of two) by one tree per row."""
        rows = len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=rows)
        column = np.arange(width)
        used = column < sizes[:, None]
        # All tables are flat; a row of links has one more column, where links past the end lead.
        grid = np.zeros((rows, width + 1), dtype=np.int32)
        grid[:, :width][used] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        paired = column[:-1] < sizes[:, None] - 1
        tree = np.full((rows, 2 * width), _NONE)
        tree[:, width : 2 * width - 1][paired] = self._keys(
            grid[:, : width - 1][paired], grid[:, 1:width][paired], np.broadcast_to(column[:-1], paired.shape)[paired], width
        )
        level = width
        while level > 1:
            level >>= 1
            np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])
        links = np.tile(np.arange(1, width + 2, dtype=np.int32), (rows, 1))
        links[np.arange(rows), sizes - 1] = width
        after, before = links.ravel(), np.tile(np.arange(-1, width, dtype=np.int32), (rows, 1)).ravel()
        ids, alive, tree = grid.ravel(), used.copy(), tree.ravel()
        live = np.flatnonzero(tree[1 :: 2 * width] != _NONE)
        while len(live):
            base, root = live * (width + 1), live * (2 * width)
            rank, i = np.divmod(tree.take(root + 1), width)
            j = after.take(base + i)
            k = after.take(base + j)
            h = before.take(base + i)
            new = self.merged.take(rank)
            ids[base + i] = new
            alive[live, j] = False
            after[base + i] = k
            before[base + k] = i
            right = np.full(len(live), _NONE)
            has = np.flatnonzero(k < width)
            right[has] = self._keys(new[has], ids.take((base + k)[has]), i[has], width)
            tree[root + width + i] = right
            tree[root + width + j] = _NONE
            has = np.flatnonzero(h >= 0)
            tree[(root + width + h)[has]] = self._keys(ids.take((base + h)[has]), new[has], h[has], width)
            # Renew the three paths, level by level.
            nodes = [i + width, j + width, np.where(h >= 0, h, i) + width]
            for _ in range(width.bit_length() - 1):
                nodes = [node >> 1 for node in nodes]
                for node in nodes:
                    at = root + 2 * node
                    tree[root + node] = np.minimum(tree.take(at), tree.take(at + 1))
            live = live[tree.take(root + 1) != _NONE]
        flat = grid[:, :width][alive].astype("<u4")
        return np.split(flat, np.cumsum(alive.sum(axis=1))[:-1])

    def merge(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each piece."""
        pieces = [t.encode() for t in texts]
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            groups.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for power, members in groups.items():
            if power == 0:
                for i in members:
                    out[i] = self.byte_ids[list(pieces[i])].astype("<u4")
            elif 1 << power <= WIDE:
                step = (1 << 18) >> power
                for a in range(0, len(members), step):
                    run = members[a : a + step]
                    for i, ids in zip(run, self.merge_wide([pieces[i] for i in run], 1 << power), strict=True):
                        out[i] = ids
            else:
                for i in members:
                    out[i] = self.merge_long(pieces[i])
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: Pieces of a generation; the vocabulary's own tables lie beside them in a worker.
_CACHE = 100_000


@lru_cache(maxsize=2)
def _piece_cache(path: str) -> PieceCache:
    merge = vocabulary(path).merge
    return PieceCache(lambda pieces: [ids.tobytes() for ids in merge(pieces)], _CACHE)


def _encoder(path: str, mark: bool, kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark_id = vocabulary(path).mark_id if mark else None
        for batch in batches:
            for run in text_slices(batch, 1):
                texts = [t or "" for t in run.column(1).to_pylist()]
                ids = [row[0].astype(kind, copy=False).tobytes() for row in encode_texts(texts, _piece_cache(path), mark_id)]
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return work


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    mark: bool = True,
    bits: int = 32,
) -> DataFrame:
    """doc_id and ids (little-endian unsigned integers of ``bits`` bits, end to end) of each row.

    ``mark=False`` reads the end-of-text mark inside a text as ordinary text.
    """
    return map_arrow(
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")),
        _encoder(path, mark, f"<u{bits // 8}"),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids binary",
    )


def _decoder(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for run in text_slices(batch, 1):
                texts = [words.decode(np.frombuffer(ids or b"", "<u4")) for ids in run.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*run.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return work


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text they stand for."""
    return map_arrow(
        encoded.select("doc_id", "ids"),
        _decoder(path),
        f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, text string",
    )
