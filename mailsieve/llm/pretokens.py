"""Cut texts into the pieces that byte-level BPE merges within, and encode each piece once.

The cutting pattern is the public one of the byte-level vocabularies. Here it is worked
out on arrays of code points: runs of one class (letter, number, space, other) are
pieces, the last blank before a run joins it, and the short English contractions after
an apostrophe are pieces of their own.

Pieces repeat a lot, so each batch is dictionary-encoded and only pieces that are not in
a bounded cache are encoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers.pre_tokenizers import ByteLevel

MARK = "<|endoftext|>"
CACHE = 300_000
#: Longer pieces are hardly ever met again; they would make the size of the cache unbounded.
_KEPT_LENGTH = 64
_OTHER, _LETTER, _NUMBER, _SPACE, _UNKNOWN = range(5)
_APOSTROPHE, _BLANK = 0x27, 0x20


@cache
def _known_kinds() -> np.ndarray:
    return np.full(0x110000, _UNKNOWN, dtype=np.uint8)


def _kind(point: str, cutter: ByteLevel) -> int:
    for kind, beside in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
        if len(cutter.pre_tokenize_str(beside + point)) == 1:
            return kind
    return _SPACE


def _kinds(points: np.ndarray) -> np.ndarray:
    """The class of each code point.

    Which points count as letters depends on the Unicode version of the tokenizer
    library, so it is asked once for each point that occurs.
    """
    known = _known_kinds()
    kinds = known[points]
    if (kinds == _UNKNOWN).any():
        cutter = ByteLevel(add_prefix_space=False, use_regex=True)
        for point in np.unique(points[kinds == _UNKNOWN]).tolist():
            known[point] = _kind(chr(point), cutter)
        kinds = known[points]
    return kinds


def _piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions where a piece starts; ``text_starts`` are the first points of non-empty texts."""
    n = len(points)
    kinds = _kinds(points)
    start = np.empty(n + 1, dtype=bool)
    start[0] = start[n] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:n])
    start[text_starts] = True
    fence = np.zeros(n + 1, dtype=bool)
    fence[text_starts] = fence[n] = True

    runs = np.flatnonzero(start)
    first, after = runs[:-1], runs[1:]
    # Space runs that something follows in the same text give up their last character.
    spaces = (kinds[first] == _SPACE) & ~fence[after]
    last = after[spaces] - 1
    start[last] = True
    joined = points[last] == _BLANK
    start[last[joined] + 1] = False

    # A lone apostrophe that no blank precedes, before s t m d re ve ll.
    lone = first[(points[first] == _APOSTROPHE) & (after - first == 1) & ~fence[after] & (after < n)]
    lone = lone[start[lone] & (kinds[np.minimum(lone + 1, n - 1)] == _LETTER)]
    if len(lone):
        one = points[lone + 1]
        inside = (lone + 2 < n) & ~fence[np.minimum(lone + 2, n)]
        two = np.where(inside, points[np.minimum(lone + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(lone), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for found, size in ((short, 1), (long, 2)):
            at = lone[found]
            start[at + 1] = False
            rest = at + 1 + size
            rest = rest[rest < n]
            start[rest[(kinds[rest] == _LETTER) & ~fence[rest]]] = True
    return np.flatnonzero(start[:n])


class Cut:
    """Pieces of a list of texts: ``codes`` into ``pieces``, ``counts`` of codes per text."""

    def __init__(self, texts: list[str]):
        whole = "".join(texts)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        if not whole:
            self.codes, self.pieces = np.empty(0, np.int64), []
            self.distinct = pa.array([], pa.large_string())
            self.counts = np.zeros(len(texts), np.int64)
            return
        points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        starts = _piece_starts(points, begins[sizes > 0])
        self.counts = np.searchsorted(starts, ends) - np.searchsorted(starts, begins)
        data = whole.encode()
        offsets = np.append(starts, len(points))
        if len(data) != len(points):
            widths = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
            offsets = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))[offsets]
        array = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)
        ).dictionary_encode()
        self.codes = array.indices.to_numpy(zero_copy_only=False)
        self.distinct = array.dictionary
        self.pieces = array.dictionary.to_pylist()


@cache
def is_space(last: str) -> bool:
    """Whether a piece with this last character is a run of spaces.

    Other pieces hold one space at most, their first character.
    """
    return bool(_kinds(np.array([ord(last)]))[0] == _SPACE)


def spread_rows(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s : s + n] for every start s and size n, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class PieceCache:
    """Encodes pieces, keeping the ids of recent ones: two generations of ``limit`` pieces.

    ``encode`` gives the ids of each piece as little-endian 32-bit integers. Only pieces of
    ``_KEPT_LENGTH`` characters at most are kept, some 200 bytes each, so the cache is bounded in
    bytes too. The pieces of one cut are a generation at least; they are in memory in any case.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = CACHE):
        self._encode, self._limit = encode, limit
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _lookup(self, cut: Cut) -> list[bytes]:
        pieces = cut.pieces
        found = list(map(self._young.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        old, unknown = self._old.get, []
        for i in missing:
            found[i] = ids = old(pieces[i])
            if ids is None:
                unknown.append(i)
        if unknown:
            for i, ids in zip(unknown, self._encode([pieces[i] for i in unknown]), strict=True):
                found[i] = ids
        if len(self._young) + len(missing) > self._limit:
            self._young, self._old = {}, self._young
        long = set(np.flatnonzero(pc.utf8_length(cut.distinct).to_numpy(zero_copy_only=False) > _KEPT_LENGTH).tolist())
        if long:
            missing = [i for i in missing if i not in long]
        young = self._young
        for i in missing:
            young[pieces[i]] = found[i]
        return found

    def ids(self, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a cut (uint32), and the number of ids of each of its pieces in order."""
        found = self._lookup(cut)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        each = sizes[cut.codes] if len(found) else np.empty(0, np.int64)
        starts = (np.cumsum(sizes) - sizes)[cut.codes] if len(found) else each
        return spread_rows(flat, starts, each) if len(found) else flat, each


def encode_texts(
    texts: list[str], cache_: PieceCache, mark_id: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray, Cut, np.ndarray]]:
    """Per text: ids, ids per piece, the batch's cut and the text's codes into its pieces.

    With a ``mark_id`` the end-of-text mark inside a text becomes that one id, as a
    tokenizer does with its special token; without, it is ordinary text. A mark has the
    code -1.
    """
    parts: list[str] = []
    spans = []
    for text in texts:
        pieces = text.split(MARK) if mark_id is not None and MARK in text else [text]
        spans.append((len(parts), len(parts) + len(pieces)))
        parts += pieces
    cut = Cut(parts)
    ids, each = cache_.ids(cut)
    code_ends = np.concatenate(([0], np.cumsum(cut.counts)))
    id_ends = np.concatenate(([0], np.cumsum(each)))[code_ends] if len(each) else np.zeros_like(code_ends)
    for a, b in spans:
        if b - a == 1:
            lo, hi = code_ends[a], code_ends[b]
            yield ids[id_ends[a] : id_ends[b]], each[lo:hi], cut, cut.codes[lo:hi]
            continue
        bits, sizes, codes = [], [], []
        for i in range(a, b):
            if i > a:
                bits.append(np.array([mark_id], dtype="<u4"))
                sizes.append(np.array([1]))
                codes.append(np.array([-1]))
            bits.append(ids[id_ends[i] : id_ends[i + 1]])
            sizes.append(each[code_ends[i] : code_ends[i + 1]])
            codes.append(cut.codes[code_ends[i] : code_ends[i + 1]])
        yield np.concatenate(bits), np.concatenate(sizes), cut, np.concatenate(codes)
