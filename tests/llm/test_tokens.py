"""Packing, BPE and token counts against the tokenizers library and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mailsieve.llm import packing
from mailsieve.llm.bpe import decode, encode, vocabulary
from mailsieve.llm.packing import best_cuts, cut_places, pack, tail_cuts
from mailsieve.llm.pretokens import PieceCache, encode_texts
from mailsieve.llm.queries import op4_packing, op6_bpe, op7_token_counts
from mailsieve.llm.token_counts import count_flat, part_number, write_flat

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD_LETTERS = [
    *"ab '\n\t s.t!1é re ASZ", "'s", "'re", "'ve", "'ll", "'S", "  ", "\n\n", "<|endoftext|>", "<|end", "don't",
    "՘", "\U00010d40", "̀", "١", "Ⅲ", "½", " ", " ", "\u0085", "😀", "ß", "ſ", "漢字",
]


def test_random_texts_encode_as_the_library_does(library):
    draw = random.Random(1)
    words = vocabulary(PATH)
    cache = PieceCache(lambda pieces: [ids.tobytes() for ids in words.merge(pieces)], limit=500)
    by_library, mark_id = packing._piece_cache(PATH)
    assert mark_id == words.mark_id
    for _ in range(400):
        texts = ["".join(draw.choice(ODD_LETTERS) for _ in range(draw.randrange(40))) for _ in range(6)]
        for text, row in zip(texts, encode_texts(texts, cache, words.mark_id), strict=True):
            assert row[0].tolist() == library_ids(library, text), repr(text)
            assert row[1].sum() == len(row[0])
            assert words.decode(row[0]) == text
        for text, row in zip(texts, encode_texts(texts, by_library, mark_id), strict=True):
            assert row[0].tolist() == library_ids(library, text), repr(text)


def test_long_pieces_and_both_trees(library):
    words = vocabulary(PATH)
    for text in ["a" * 5000, "ab" * 4000, " " * 3000, "é" * 900, "supercali" * 300, "!?" * 900, "a", "ab"]:
        assert words.merge_long(text.encode()).tolist() == library_ids(library, text) if len(text) > 1 else True
    draw = random.Random(2)
    texts = ["".join(draw.choice("aeinrst") for _ in range(draw.randrange(2, 33))) for _ in range(3000)]
    for text, ids in zip(texts, words.merge(texts), strict=True):
        assert ids.tolist() == library_ids(library, text)
        assert words.merge_long(text.encode()).tolist() == ids.tolist()


def test_op6_equals_the_library(spark, small, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = op6_bpe(spark, small).collect()
    assert len(found) == len(rows)
    for row in found:
        ids = library_ids(library, rows[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_odd_rows(odd, empty, library):
    found = decode(encode(odd, PATH), PATH).collect()
    assert sorted((r.text for r in found)) == sorted((r.text or "") for r in odd.collect())
    for row in found:
        assert np.frombuffer(row.ids, "<u4").tolist() == library_ids(library, row.text)
    assert decode(encode(empty, PATH), PATH).count() == 0


def padded(length, size=2048):
    return length if length & (length - 1) == 0 else size


def check_pieces(pieces, rows, library, size=2048):
    """pieces: (doc_id, start, length, crc, doc_tokens, sequence_id, offset). Returns the padding share."""
    expected = sorted(((i, [*library_ids(library, t), 1]) for i, t in rows), key=repr)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p[0]].append(p)
    for i in {i for i, _ in expected}:
        texts = sorted(ids for j, ids in expected if j == i)
        starts = sorted(by_doc[i], key=lambda p: p[1])
        assert sum(p[2] for p in starts) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for p in starts:
                assert p[1] == at and p[4] == len(texts[0])
                assert p[3] == zlib.crc32(np.array(texts[0][at : at + p[2]], "<u4").tobytes())
                at += p[2]
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p[5]].append(p)
    used = held = 0
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p[6]):
            assert p[6] == at and p[2] > 0
            at += p[2]
        assert at <= size
        used, held = used + at, held + padded(at, size)
    return 1 - used / held


def test_op4_packs_all_ids(spark, small, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    found = [tuple(r) for r in op4_packing(spark, small).select(names).collect()]
    assert check_pieces(found, rows, library) < 0.02


@pytest.mark.parametrize("stretch", [1, 5000, 1 << 20])
def test_packing_odd_rows_in_any_stretch(odd, empty, library, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    found = [
        (r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset)
        for r in pack(odd, PATH).collect()
    ]
    assert check_pieces(found, [(r.doc_id, r.text) for r in odd.collect()], library) < 0.2
    assert pack(empty, PATH).count() == 0


def plain_least(places, costs, size):
    at, least = [0, *places], [0]
    for i in range(1, len(at)):
        least.append(
            costs[i - 1]
            + min(
                least[j] + (0 if (at[i] - at[j]).bit_count() == 1 else size - (at[i] - at[j]))
                for j in range(i)
                if at[i] - at[j] <= size
            )
        )
    return least[-1]


def test_cuts_are_the_cheapest():
    draw = random.Random(4)
    for _ in range(60):
        ends = np.unique(np.array([draw.randrange(1, 900) for _ in range(draw.randrange(1, 12))]))
        marks = np.array(sorted(draw.sample(range(1, int(ends[-1]) + 1), min(20, int(ends[-1])))))
        places, costs = cut_places(ends, marks, 8, 4, 20)
        cuts = best_cuts(places, costs, 64)
        cost = dict(zip(places.tolist(), costs.tolist(), strict=True))
        total = 0
        for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
            assert 0 < b - a <= 64
            total += cost[b] + (0 if (b - a).bit_count() == 1 else 64 - (b - a))
        assert cuts[-1] == ends[-1]
        assert total == plain_least(places.tolist(), costs.tolist(), 64)
    assert tail_cuts(1024 + 512, 2048, 64) == [1024, 1536]
    assert tail_cuts(2047, 2048, 64) == [2047]


def test_op7_counts_every_document(spark, small, library):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    found = {r.doc_id: r for r in op7_token_counts(spark, small).collect()}
    assert len(found) == len(rows)
    for row in rows:
        assert found[row.doc_id].n_tokens == len(plain.encode(row.text or "", add_special_tokens=False).ids)
        assert found[row.doc_id].ended


def test_flat_files_of_odd_rows(spark, odd, empty, tmp_path):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    names = write_flat(odd, PATH, str(tmp_path / "odd"))
    counts = count_flat(spark, str(tmp_path / "odd"), block=64).withColumn("part", part_number("path"))
    found = sorted((r.doc_id, r.n_tokens) for r in counts.join(names, ["part", "ordinal"]).collect() if r.doc_id)
    assert found == sorted(
        (r.doc_id, len(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect() if r.doc_id
    )
    assert counts.count() == odd.count()
    write_flat(empty, PATH, str(tmp_path / "empty"))
    assert count_flat(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("block", [2, 6, 10, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block):
    """Separators at block edges, misaligned separator bytes, empty documents, an open end."""
    ids = [5, 50256, 50256, 7, 0x5011, 0x22C4, 9, 50256, 1, 2, 3, 4, 5, 6, 50256, 8, 8]
    (tmp_path / "part-00000").write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "part-00001").write_bytes(b"")
    (tmp_path / "part-00002").write_bytes(np.array([50256], "<u2").tobytes())
    found = sorted(
        (int(r.path[-1]), r.ordinal, r.start, r.n_tokens, r.ended)
        for r in count_flat(spark, str(tmp_path), block=block).collect()
    )
    assert found == [
        (0, 0, 0, 1, True), (0, 1, 2, 0, True), (0, 2, 3, 4, True), (0, 3, 8, 6, True), (0, 4, 15, 2, False),
        (2, 0, 0, 0, True),
    ]


def test_names_do_not_depend_on_a_second_split(spark, tmp_path, library):
    """The documents are split otherwise when the result is read than when files were written."""
    texts = {i: "word " * (i % 37) for i in range(400)}
    table = tmp_path / "documents.parquet"
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8).write.parquet(str(table))
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(256 << 20))  # a split for each file
        result = op7_token_counts(spark, str(tmp_path))
        spark.conf.set(key, "1")  # files share splits
        found = sorted((r.doc_id, r.n_tokens) for r in result.collect())
    finally:
        spark.conf.set(key, before)
    assert found == sorted((i, len(library_ids(library, t))) for i, t in texts.items())


def test_names_of_any_kind_and_separator(spark, tmp_path):
    """Text ids with odd letters, a null id, and separators that look like parts of a name."""
    ids = ["a b", "", "-", "#1 41", "x\ny", "漢字PÄ", None]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id string, text string").coalesce(1)
    for separator in (50256, 0x230A, 0x0A31, 0x3131):
        folder = str(tmp_path / str(separator))
        names = write_flat(docs, PATH, folder, separator=separator)
        assert [r.doc_id for r in names.orderBy("ordinal").collect()] == ids
        counts = count_flat(spark, folder, separator=separator)
        assert [r.n_tokens for r in counts.collect()] == [1] * len(ids)
