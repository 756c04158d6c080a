"""License scan by a positional index of rare words, in DataFrame operations only.

A template is a run of words of a license text with a mandatory key phrase inside. Over all
documents the number of texts with each template word is counted. The word of highest inverse
frequency in a template's key phrase is its anchor: the posting under which the template is
found, with the word's position. Then, per document:

1. of its license words those of highest inverse frequency in their template are looked up, with
   their positions and the words around them,
2. a posting and a position give the place where the template would begin; postings of the other
   template words are intersected at their relative positions around it, and what is met must
   come to ``SHARE`` of the template's inverse frequency,
3. the key phrase must stand there whole and in order.

So a key phrase alone, in words that have nothing else of the license, gives no label; a base
phrase is a template of its own. As every place of a key phrase holds its anchor, whichever
license words a document has beside it, no place is missed. Documents without an
anchor are done after the first step. The index is as large as the table of templates,
which bounds what is broadcast; hits are grouped by row, and no key is shared by rows.

Defined results: words are runs of digits, small letters after lower-casing A-Z, and all
characters beyond ASCII; a null text counts as the empty text and has no words; positions
count words from 0 and are null without a hit; overlapping places all count; equal rows are
scanned one by one; null ids pass through; an empty table gives an empty result; extra
columns of any name are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import ascii_lower

SHARE = 0.6

# What separates words, and the base phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# (label, words, key phrase within the words); a base phrase is its own key phrase.
TEMPLATES = [
    *[(label, phrase, phrase) for phrase, label in BASE.items()],
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("epl", "made available under the eclipse public license", "eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software", "use copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("cc0", "licensed under cc0 1 0", "cc0 1 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("creative-commons", "licensed under a creative commons attribution license", "creative commons attribution"),
]


def _split(text: Column) -> Column:
    return F.split(ascii_lower(text), SEPARATORS)


def _word_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row_no, doc_id, raw (split text), lead (1 if a blank is first), n_words."""
    blank_first = (F.element_at("raw", 1) == "").cast("int")
    blank_last = ((F.element_at("raw", -1) == "") & (F.size("raw") > 1)).cast("int")
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        docs[id_col].alias("doc_id"),
        _split(docs[text_col]).alias("raw"),
    ).select(
        "row_no", "doc_id", "raw", blank_first.alias("lead"), (F.size("raw") - blank_first - blank_last).cast("bigint").alias("n_words")
    )


def word_frequencies(docs: DataFrame, words: list[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of documents that hold each of ``words``."""
    wanted = F.array(*map(F.lit, words))
    held = docs.select(F.array_intersect(_split(docs[text_col]), wanted).alias("held"))
    rows = held.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def _postings(templates, rarity: dict[str, float]) -> list[tuple]:
    """One row per template: its anchor and where things are relative to it."""
    rows = []
    for number, (label, text, phrase) in enumerate(templates):
        words, key = text.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        single = [w for w in key if key.count(w) == 1]
        anchor = max(single, key=lambda w: (rarity[w], -key.index(w)))
        rows.append(
            (number, label, phrase in BASE, anchor, key.index(anchor), key, at, words, [float(rarity[w]) for w in words])
        )
    return rows


def scan(
    docs: DataFrame, templates=None, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places (template, label, base, word, matched)."""
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    n_docs, counts = word_frequencies(docs, vocabulary, text_col)
    rarity = {w: math.log((n_docs + 1) / (counts.get(w, 0) + 0.5)) + 1 for w in vocabulary}
    rarity = {w: max(0.0, r) for w, r in rarity.items()}
    rows = _postings(templates, rarity)
    spark = docs.sparkSession
    postings = spark.createDataFrame(
        rows,
        "template int, label string, base boolean, anchor string, in_key int, key array<string>, "
        "key_at int, words array<string>, rarity array<double>",
    )
    anchors = sorted({r[3] for r in rows})
    reach = max(len(r[7]) for r in rows)
    places = F.filter(F.transform("raw", lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull())
    hits = F.transform(
        places,
        lambda i: F.struct(
            i.alias("at"),
            F.element_at("raw", i + 1).alias("word"),
            F.greatest(i - reach, F.lit(0)).alias("from"),
            F.slice("raw", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near"),
        ),
    )
    found = _word_rows(docs, id_col, text_col).select(
        "row_no", "doc_id", "n_words", "lead", F.explode_outer(hits).alias("hit")
    )
    begin = F.col("hit.at") - F.col("in_key") - F.col("hit.from")  # of the key phrase, in ``near``
    whole = (begin >= 0) & (
        F.slice("hit.near", F.greatest(begin, F.lit(0)) + 1, F.size("key")) == F.col("key")
    )
    start = begin - F.col("key_at")  # of the template, in ``near``; may lie before the text
    matched = F.aggregate(
        F.sequence(F.lit(0), F.size("words") - 1),
        F.lit(0.0),
        lambda s, i: s
        + F.when(
            (start + i >= 0) & (F.get("hit.near", F.greatest(start + i, F.lit(0))) == F.get("words", i)), F.get("rarity", i)
        ).otherwise(0.0),
    )
    verified = (
        found.join(F.broadcast(postings), F.col("hit.word") == F.col("anchor"), "left")
        .withColumn("whole", F.coalesce(whole, F.lit(False)))
        .withColumn("word", (F.col("hit.at") - F.col("in_key") - F.col("lead")).cast("bigint"))
        .withColumn("matched", F.when(F.col("whole"), matched).otherwise(0.0))
    )
    enough = F.col("matched") >= share * F.aggregate("rarity", F.lit(0.0), lambda s, x: s + x)
    place = F.when(F.col("whole") & (F.col("base") | enough), F.struct("template", "label", "base", "word", "matched"))
    return verified.groupBy("row_no", "doc_id", "n_words").agg(F.collect_list(place).alias("places")).drop("row_no")


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 - exp(-m / 10) for the largest inverse frequency m matched at a place.
    """
    base = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    strongest = F.array_max(F.transform("places", lambda p: p["matched"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["word"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.coalesce(1 - F.exp(-strongest / 10), F.lit(0.0)).alias("score"),
    )
