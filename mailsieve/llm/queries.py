"""One query per operator over its whole table; the SQL of those that it can express is in ``sql``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.llm import centroids, decontamination, licenses, quality, topk, toxicity
from mailsieve.llm.bpe import decode, encode
from mailsieve.llm.common import table
from mailsieve.llm.exact_dedup import copy_groups
from mailsieve.llm.packing import pack
from mailsieve.llm.prefix_trie import prefix_trie
from mailsieve.llm.secret_scan import STRONG, scan_secrets, span_list
from mailsieve.llm.simhash import near_groups
from mailsieve.llm.sql import ORACLES
from mailsieve.llm.token_counts import count_flat, part_number, write_flat
from mailsieve.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]


def vocabulary_path() -> str:
    """The public byte-level vocabulary, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judged(toxicity.score(docs, grammar), 0.5)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path()).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"), vocabulary_path())
    return decode(encoded, vocabulary_path()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document of the flat token files that ``documents`` are written to."""
    folder = scratch_path(spark, "token-files")
    names = write_flat(table(spark, sf_dir, "documents"), vocabulary_path(), folder)
    counts = count_flat(spark, folder).withColumn("part", part_number("path"))
    return counts.join(names, ["part", "ordinal"], "left").select(
        "doc_id", "part", "ordinal", "start", "n_tokens", "ended"
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judged(quality.score(docs, model), 0.3)


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*STRONG))
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in STRONG],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.summary(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.summary(found)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_topk": op5_topk,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_centroids": op11_centroids,
    "op12_decontamination": op12_decontamination,
    "op13_prefix_trie": op13_prefix_trie,
}
