"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most
``max_bits`` = 2 bits agree in at least six of them; that is the guaranteed minimum of
matches. The index holds distinct fingerprints, so copies cost nothing:

1. Bytes are taken in four neighbouring couples. Two differing bytes spoil at most two of
   them, so a pair to be found shares two whole couples: each fingerprint is posted
   under the six choices of two couples, with those four bytes as the key.
2. Short posting lists: the shared positional bytes of the members are tallied,
   pairs that reach six are kept and verified by their differing bits.
3. Lists longer than ``LIST`` are never opened. Their members are posted again under two
   more of the four free positions, which the minimum of six guarantees to agree. Such a
   list has six bytes in common and two free ones, hence 65,536 distinct members at most.
   All its members reach the minimum, and verification goes through the table of the
   16 free bits.

A list yields links of each member to the smallest one it reaches inside the list, never
all pairs. Links of all lists are joined to components as tables. No list, candidate or
partner is capped.

Defined results: a null text counts as the empty text; texts without words have the
fingerprint zero and are linked like any other; null ids are never a component's name
unless all its ids are null; equal rows share a component; an empty table gives an
empty result; extra columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import free_names, map_arrow, written
from mailsieve.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
LIST = 512
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    # Bytes methods know ASCII only: A-Z are lowered, \x20 and \x09-\x0d separate.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)],
        dtype="<u8",
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        octets = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, *more: str):
    """Rows of id, text and more columns to id, fingerprint and the same columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *more]
            )

    return work


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row."""
    return map_arrow(
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")),
        _fingerprints(shingle),
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp bigint",
    )


def _byte(position: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(0xFF))


def _posting(positions: tuple[int, ...]) -> Column:
    """Key of one index entry: which positions, and their bytes."""
    mask = sum(1 << p for p in positions)
    value = _byte(positions[0])
    for p in positions[1:]:
        value = F.shiftleft(value, 8).bitwiseOR(_byte(p))
    return F.struct(F.lit(mask).alias("positions"), value.alias("bytes"))


COUPLES = [(2 * i, 2 * i + 1) for i in range(4)]
FOURS = [a + b for a, b in combinations(COUPLES, 2)]


def _sixes() -> Column:
    """For an entry under four positions: its entries under two more of the free ones."""
    choice = None
    for four in FOURS:
        free = [p for p in range(BYTES) if p not in four]
        entries = F.array(*[_posting(tuple(sorted((*four, *two)))) for two in combinations(free, 2)])
        same = F.col("posting.positions") == sum(1 << p for p in four)
        choice = F.when(same, entries) if choice is None else choice.when(same, entries)
    return choice


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _least_reached(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links, the smallest node each one reaches."""
    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, left, least[right])
        np.minimum.at(new, right, least[left])
        new = np.minimum(new, new[new])
        if np.array_equal(new, least):
            return least
        least = new


def _tally_links(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Smallest member reached, by tallied positional bytes and verified bits."""
    octets = fps.view(np.uint8).reshape(-1, BYTES)
    shared = np.zeros((len(fps), len(fps)), dtype=np.uint8)
    for p in range(BYTES):
        shared += octets[:, None, p] == octets[None, :, p]
    left, right = np.nonzero(np.triu(shared >= BYTES - max_bits, 1))
    near = _bits(fps[left] ^ fps[right]) <= max_bits
    return _least_reached(len(fps), left[near], right[near])


def _table_links(fps: np.ndarray, mask: int, max_bits: int) -> np.ndarray:
    """The same for members that share six bytes, through the table of their free bits."""
    free = [p for p in range(BYTES) if not mask >> p & 1]
    octets = fps.view(np.uint8).reshape(-1, BYTES)
    slot = octets[:, free[0]].astype(np.int64) | octets[:, free[1]].astype(np.int64) << 8
    place = np.full(1 << 16, -1, dtype=np.int64)
    place[slot] = np.arange(len(fps))
    left, right = [], []
    for n in range(1, max_bits + 1):
        for bits in combinations(range(16), n):
            other = place[slot ^ sum(1 << b for b in bits)]
            hit = np.nonzero(other > np.arange(len(fps)))[0]
            left.append(hit)
            right.append(other[hit])
    return _least_reached(len(fps), np.concatenate(left), np.concatenate(right))


def _open_lists(max_bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, starts = [], []
            for mask, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                fps = np.sort(members.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                fits = len(fps) <= 2 * LIST or mask.bit_count() < BYTES - max_bits
                least = _tally_links(fps, max_bits) if fits else _table_links(fps, mask, max_bits)
                linked = np.nonzero(least != np.arange(len(fps)))[0]
                ends.append(fps[linked].view(np.int64))
                starts.append(fps[least[linked]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *x])) for x in (ends, starts)], ["a", "b"]
            )

    return work


def _links_of(postings: DataFrame, max_bits: int) -> DataFrame:
    lists = postings.groupBy("posting").agg(F.collect_list("fp").alias("members"))
    return map_arrow(lists.select("posting.positions", "members"), _open_lists(max_bits), "a bigint, b bigint")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``fps`` at ``max_bits`` or fewer."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the couples of bytes guarantee pairs at two bits or fewer")
    fours = fps.select("fp", F.explode(F.array(*map(_posting, FOURS))).alias("posting"))
    lengths = written(fours.groupBy("posting").count().where("count > 1"), "lists")
    postings = fours.join(lengths, "posting")
    short = postings.where(F.col("count") <= LIST).select("posting", "fp")
    again = (
        postings.where(F.col("count") > LIST)
        .select("fp", F.explode(_sixes()).alias("posting"))
        .distinct()
    )
    return _links_of(short, max_bits).unionByName(_links_of(again, max_bits))


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest id reachable)."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct-fingerprints")
    roots = components(links(nodes, max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(rooted.join(names, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest id.

    Ids may repeat or be null: a row is told by its id and its text, rows without an id come
    last, and equal ids are told apart by fingerprint and text digest. Of rows equal in id and
    text one stays.
    """
    gone, gone_id, gone_digest = free_names(docs.columns, "_gone", "_gone_id", "_gone_digest")
    name = F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    prints = written(
        map_arrow(
            texts.select("doc_id", "text", _digest(F.col("text")).alias("digest")),
            _fingerprints(shingle, "digest"),
            f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp bigint, digest binary",
        ),
        "fingerprints",
    )
    keys = written(prints.groupBy("doc_id", "digest", "fp").count(), "document-keys")
    nodes = written(keys.groupBy("fp").agg(F.min(F.struct(*name, "fp", "digest")).alias("first")), "distinct-fingerprints")
    roots = components(links(nodes, max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    winners = rooted.groupBy("root").agg(F.min("first").alias("winner"))
    named = written(rooted.join(winners, "root").select("fp", "winner"), "components")
    wins = F.col("winner") == F.struct(*name, "fp", "digest")
    verdicts = keys.join(named, "fp").select("doc_id", "digest", (~wins).alias(gone), "count")
    touched = written(
        verdicts.where(F.col(gone) | (F.col("count") > 1)).select(
            F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest), gone
        ),
        "near-copies",
    )
    same = F.col(id_col).eqNullSafe(F.col(gone_id)) & (_digest(F.col(text_col).cast("string")) == F.col(gone_digest))
    marked = docs.join(touched, same, "left")
    single = marked.where(F.col(gone).isNull())
    repeated = touched.where(~F.col(gone))
    if repeated.isEmpty():
        return single.select(*docs.columns)
    again = marked.where(~F.col(gone)).dropDuplicates([gone_id, gone_digest])
    return single.unionByName(again).select(*docs.columns)


def _digest(text: Column) -> Column:
    """SHA-256 of a text; a null text counts as the empty one, as for fingerprints."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
