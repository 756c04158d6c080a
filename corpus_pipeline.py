"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table that the next one gets as its
``docs``; all but the last return the columns of ``docs``. What a stage drops is gone for
all later ones. Between stages the table is written and read again, so a lost executor
never costs more than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.llm import toxicity
from mailsieve.llm.common import table, written
from mailsieve.llm.exact_dedup import drop_copies
from mailsieve.llm.packing import pack
from mailsieve.llm.queries import vocabulary_path
from mailsieve.llm.secret_scan import mask_secrets
from mailsieve.llm.simhash import drop_near_copies


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the largest id, of those that are equal after lower-casing A-Z."""
    return drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of linked fingerprints."""
    return drop_near_copies(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and linked credential parts masked; ``n_chars`` follows."""
    masked = mask_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.char_length("text").cast(kind))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2,048 ids."""
    return pack(docs, vocabulary_path()).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "ids",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_duplicates),
    ("secrets", mask),
    ("packing", pack_sequences),
]

# Scores, fingerprints and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
