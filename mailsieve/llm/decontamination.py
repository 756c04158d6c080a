"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over all texts.

Texts are normalised to words: A-Z lower-cased, runs of digits, letters and all characters
beyond ASCII. The windows of an item are its runs of ``n`` words; an item of fewer words is one
window. All windows of a block of items go to the workers as one hash set: a bit table that
nearly every other window of a text fails, the sorted hashes, and the normalised items
themselves. A text is scanned as arrays: word hashes from one running sum over its bytes,
window hashes from ``n`` shifted sums. Windows in the set are verified word by word against the
item, so an equal hash alone is never a hit. Words inside any verified window are hit.

What is broadcast is bounded: items are cut by a hash into blocks of about ``block_bytes`` of
text, as many as their measured total needs. One block, the usual case, is one pass without a
shuffle. With more blocks each is broadcast and scanned on its own, the places found are stored
under the text's digest and brought together by it; documents of equal text share that row.

``find_hits`` returns the places, ``drop_contaminated`` the clean documents with all their
columns, ``cut_spans`` all documents without the places.

Defined results: a null or empty text and an item without words have no windows; items are told
apart by id, so rows that repeat an id are one item; items without an id count as one more and
have no name in a list of ids; equal documents are reported one by one; null ids pass through;
an empty table gives an empty result and an empty benchmark leaves every document clean; extra
columns of any name are not read, and are returned as they are where rows are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import free_names, map_arrow, written

WINDOW = 10
BLOCK_BYTES = 4 << 20
_HITS = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
_SPANS = "array<struct<start:bigint,end:bigint>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xC2B2AE3D27D4EB4F | 1


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def _word_bytes() -> np.ndarray:
    """Digits, letters and every byte of a character beyond ASCII."""
    inside = np.zeros(256, bool)
    inside[ord("0") : ord("9") + 1] = inside[ord("a") : ord("z") + 1] = inside[128:] = True
    return inside


_LOWER, _INSIDE = _lowered(), _word_bytes()
#: Bytes are mixed to numbers of 64 bits before they are summed up.
_MIXED = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out[:n]


class _Bases:
    """Powers of the byte base and of its inverse, as many as the longest run of bytes needed."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BYTE_BASE, n), _powers(pow(_BYTE_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


_PART = 1 << 21


class Words:
    """Words of texts laid end to end: byte places and hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes], bases: _Bases):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(sizes + 1) - sizes - 1
        # A blank between texts keeps their words apart; another one at the end closes the last.
        self.data = _LOWER[np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)]
        inside = np.concatenate(([False], _INSIDE[self.data], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.firsts = np.append(np.searchsorted(self.starts, begins), len(self.starts))
        self.hashes = self._hashes(bases)

    def _hashes(self, bases: _Bases) -> np.ndarray:
        """Sum of byte * base ** place over a word, shifted back to its start, and mixed."""
        found = np.empty(len(self.starts), np.uint64)
        # In parts, cut between words, so that a long text needs no long arrays of powers.
        done = 0
        while done < len(found):
            at = int(self.starts[done])
            upto = max(done + 1, int(np.searchsorted(self.ends, at + _PART, side="right")))
            size = int(self.ends[upto - 1]) - at
            up, down = bases.upto(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_MIXED[self.data[at : at + size]] * up, out=sums[1:])
            a, b = self.starts[done:upto] - at, self.ends[done:upto] - at
            found[done:upto] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
            done = upto
        return _mix(found)

    def windows(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each place on; too few at the end give fewer places."""
        count = len(self.hashes) - n + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        total = np.zeros(count, np.uint64)
        for i in range(n):
            total += self.hashes[i : i + count] * np.uint64(pow(_WORD_BASE, i, 1 << 64))
        return _mix(total)

    def line(self, first: int, last: int) -> bytes:
        """Words from ``first`` up to but without ``last``, separated by blanks."""
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last], strict=True)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class WindowSet:
    """The windows of a block of items: by length, sorted hashes with the places they stand for."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        """``items`` are (name, text); rows that share a name are one item."""
        self.names = sorted({name for name, _ in items}, key=_last_if_none)
        number = {name: i for i, name in enumerate(self.names)}
        words = Words([text for _, text in items], _Bases())
        owners, lengths, places = [], [], []
        for i, (name, _) in enumerate(items):
            first, last = int(words.firsts[i]), int(words.firsts[i + 1])
            if last > first:
                size = min(n, last - first)
                places.append(np.arange(first, last - size + 1))
                owners.append(np.full(len(places[-1]), number[name]))
                lengths.append(np.full(len(places[-1]), size))
        none = np.empty(0, np.int64)
        place, owner, length = (np.concatenate([none, *x]) for x in (places, owners, lengths))
        self.tables = [
            _Table(words, size, place[length == size], owner[length == size]) for size in np.unique(length).tolist()
        ]
        words.hashes = None  # not needed any more, and not sent


def _last_if_none(name: str | None) -> tuple:
    return name is None, name or ""


class _Table:
    """Distinct windows of one length: their hashes in order, a place of each in the items' words,
    and the numbers of the items that hold them, end to end."""

    def __init__(self, words: Words, size: int, places: np.ndarray, owners: np.ndarray):
        self.words, self.size = words, size
        hashes = words.windows(size)[places]
        order = np.argsort(hashes, kind="stable")
        hashes, places, owners = hashes[order], places[order], owners[order]
        edges = [0, *(np.flatnonzero(hashes[1:] != hashes[:-1]) + 1).tolist(), len(hashes)]
        firsts, counts, members = [], [], []
        for a, b in zip(edges, edges[1:], strict=False):
            # Windows of one hash are told apart by their words.
            by_text: dict[bytes, list[int]] = {}
            for i in range(a, b):
                text = b"" if b - a == 1 else words.line(places[i], places[i] + size)
                by_text.setdefault(text, []).append(i)
            for same in by_text.values():
                holders = np.unique(owners[same])
                firsts.append(same[0])
                counts.append(len(holders))
                members.append(holders)
        self.hashes, self.places = hashes[firsts], places[firsts]
        self.ends = np.cumsum(counts)
        self.members = np.concatenate(members).astype(np.int32)
        bits = max(16, (16 * len(firsts) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(self.hashes >> self.shift).astype(np.int64)] = True

    def holders(self, i: int) -> list[int]:
        return self.members[self.ends[i - 1] if i else 0 : self.ends[i]].tolist()

    def found(self, words: Words) -> tuple[list[int], list[int]]:
        """Verified windows of texts: first words, and the numbers of the table's windows."""
        hashes = words.windows(self.size)
        maybe = np.flatnonzero(self.seen[(hashes >> self.shift).astype(np.int64)])
        low = np.searchsorted(self.hashes, hashes[maybe])
        known = self.hashes[np.minimum(low, len(self.hashes) - 1)] == hashes[maybe]
        at, number = [], []
        for place, i in zip(maybe[known].tolist(), low[known].tolist(), strict=True):
            line, h = words.line(place, place + self.size), self.hashes[i]
            while i < len(self.hashes) and self.hashes[i] == h:
                if self.words.line(self.places[i], self.places[i] + self.size) == line:
                    at.append(place)
                    number.append(i)
                    break
                i += 1
        return at, number


def scan(texts: list[bytes], windows: WindowSet, bases: _Bases) -> list[dict]:
    """For each text: number of words, hit runs of words (start, end), names of the items."""
    words = Words(texts, bases)
    out = [
        {"n_words": int(n), "spans": [], "items": []} for n in np.diff(words.firsts)
    ]
    hit = np.zeros(len(words.starts) + 1, np.int32)
    items: dict[int, set[int]] = {}
    for table in windows.tables:
        at, number = table.found(words)
        owner = np.searchsorted(words.firsts, at, side="right") - 1
        for place, i, text in zip(at, number, owner.tolist(), strict=True):
            # Words of the next text follow at once: a window across is none.
            if place + table.size <= words.firsts[text + 1]:
                hit[place] += 1
                hit[place + table.size] -= 1
                items.setdefault(text, set()).update(table.holders(i))
    if not items:
        return out
    covered = np.concatenate(([False], np.cumsum(hit[:-1]) > 0, [False]))
    for text, numbers in items.items():
        first, last = int(words.firsts[text]), int(words.firsts[text + 1])
        inside = np.concatenate(([False], covered[first + 1 : last + 1], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        out[text]["spans"] = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
        out[text]["items"] = [windows.names[i] for i in sorted(numbers)]
    return out


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _scanner(shared, keep_text: bool, hits: str):
    """Rows whose last column is the text to rows with the hits after (or in place of) it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = _Bases()
        for batch in batches:
            found = scan(_bytes_of(batch.columns[-1]), shared.value, bases)
            columns = [*batch.columns[: None if keep_text else -1], pa.array(found, _FOUND)]
            names = [*batch.schema.names[: None if keep_text else -1], hits]
            yield pa.RecordBatch.from_arrays(columns, names)

    return work


def _window_sets(benchmark: DataFrame, item_col: str, text_col: str, n: int, block_bytes: int) -> Iterator[WindowSet]:
    """One set per block of items; at least one."""
    texts = benchmark.select(
        benchmark[item_col].cast("string").alias("item"), F.coalesce(benchmark[text_col].cast("string"), F.lit("")).alias("text")
    )
    items = written(texts.select("item", "text", F.octet_length("text").alias("size")), "benchmark-items")
    total = items.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    parts = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for i in range(parts):
        rows = items.where(part == i).select("item", "text").collect()  # about block_bytes
        yield WindowSet([(r.item, r.text.encode()) for r in rows], n)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    hits: str,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a column ``hits`` of n_words, spans and items; its name must be free.

    ``keep_text=False`` leaves the text out, so that it does not travel back from the workers.
    """
    sc = docs.sparkSession.sparkContext
    sets = _window_sets(benchmark, item_col, item_text_col, n, block_bytes)
    first, second = next(sets), next(sets, None)
    others = [f for f in docs.schema.fields if f.name != text_col]
    text, digest, key, spans, items = free_names([*docs.columns, hits], "text", "digest", "key", "spans", "items")
    given = docs.select(*[docs[f.name] for f in others], docs[text_col].cast("string").alias(text))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    kept = f"`{text}` string, " if keep_text else ""
    if second is None:
        work = _scanner(sc.broadcast(first), keep_text, hits)
        return _ordered(map_arrow(given, work, f"{kinds}{kept}`{hits}` {_HITS}"), docs, text, text_col, hits, keep_text)

    # More than one block: places by digest, brought together, and joined to the rows.
    digested = given.select(_digest(F.col(text)).alias(key), F.col(text))
    every = None
    for windows in chain((first, second), sets):
        shared = sc.broadcast(windows)
        one = map_arrow(digested, _scanner(shared, False, hits), f"`{key}` binary, `{hits}` {_HITS}")
        found = written(
            one.where(F.size(F.col(hits)["spans"]) > 0).groupBy(key).agg(F.first(hits).alias(hits)), "block-hits"
        )
        shared.destroy()
        every = found if every is None else every.unionByName(found)
    merged = written(
        every.groupBy(key).agg(
            # A list per block at most.
            F.array_sort(F.flatten(F.collect_list(F.col(hits)["spans"]))).alias(spans),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.col(hits)["items"])))).alias(items),
        ),
        "hits",
    )
    joined = given.withColumn(digest, _digest(F.col(text))).join(merged, F.col(digest) == F.col(key), "left")
    found = F.struct(
        _word_count(F.col(text)).alias("n_words"),
        _joined(F.coalesce(F.col(spans), F.array().cast(_SPANS))).alias("spans"),
        F.coalesce(F.col(items), F.array().cast("array<string>")).alias("items"),
    )
    return _ordered(joined.withColumn(hits, found), docs, text, text_col, hits, keep_text)


def _word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")


def _joined(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch as one."""

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = F.coalesce(last["end"] >= span["start"], F.lit(False))
        return F.when(touches, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, F.array().cast(_SPANS), add)


def _ordered(marked: DataFrame, docs: DataFrame, text: str, text_col: str, hits: str, keep_text: bool) -> DataFrame:
    """Columns in the order of ``docs``, then the hits."""
    columns = [
        F.col(text).alias(text_col) if name == text_col else F.col(name)
        for name in docs.columns
        if keep_text or name != text_col
    ]
    return marked.select(*columns, hits)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """doc_id, n_words, spans (start and end of hit runs of words), items (ids, sorted as strings)."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return with_hits(narrow, benchmark, "hits", keep_text=False, **options).select("doc_id", "hits.*")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of rows of ``find_hits``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least_share: float = 0.0, **options
) -> DataFrame:
    """The rows of ``docs`` that stay: those without a hit, or with a share of hit words not
    above ``least_share``."""
    (hits,) = free_names(docs.columns, "_hits")
    marked = with_hits(docs, benchmark, hits, text_col, **options)
    n_hit = F.aggregate(F.col(hits)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.where((n_hit == 0) | (n_hit <= F.lit(float(least_share)) * F.col(hits)["n_words"])).select(*docs.columns)


def _cut(text: str, spans: list, bases: _Bases, mark: bytes) -> str:
    data = text.encode()
    words = Words([data], bases)
    out, at = [], 0
    for span in spans:
        out += [data[at : int(words.starts[span["start"]])], mark]
        at = int(words.ends[span["end"] - 1])
    return b"".join([*out, data[at:]]).decode()


def _cutter(at: int, mark: bytes):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = _Bases()
        for batch in batches:
            texts, hits = batch.column(at), batch.columns[-1].field("spans")
            if max(pc.list_value_length(hits).to_pylist(), default=0):
                cut = [
                    _cut(t, s, bases, mark) if s else t
                    for t, s in zip(texts.to_pylist(), hits.to_pylist(), strict=True)
                ]
                texts = pa.array(cut, pa.string())
            columns = [*batch.columns[:at], texts, *batch.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return work


def cut_spans(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", mark: str = "", **options
) -> DataFrame:
    """All rows of ``docs``, with ``mark`` in place of every hit run, first to last word."""
    (hits,) = free_names(docs.columns, "_hits")
    marked = with_hits(docs, benchmark, hits, text_col, **options)
    kinds = ", ".join(
        f"`{f.name}` {'string' if f.name == text_col else f.dataType.simpleString()}" for f in docs.schema.fields
    )
    return map_arrow(marked, _cutter(docs.columns.index(text_col), mark.encode()), kinds)
