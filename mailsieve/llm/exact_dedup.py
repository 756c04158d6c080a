"""Exact duplicates with a heavy-hitter split, in DataFrame operations only.

1. One pass over the texts writes a key table: id, digest, row number (about 80 bytes a row).
2. Misra-Gries counters (``freqItems``) name every digest that can hold more than
   ``support`` of the rows: at most ``1 / support`` names, some of them false.
3. An exact count verifies them; the verified ones with their winning row are
   broadcast, at most ``1 / support`` rows of fixed width, and settle their rows where
   those lie. No key that is common reaches a shuffle.
4. The other digests are grouped and joined by ordinary shuffles.

Defined results: a null text counts as the empty text, so all null and empty texts are
one group. Of equal texts the largest id stays; a null id is smaller than any other.
Rows that repeat both id and text are copies too: exactly one of them stays, the last
by position in the table. An empty table gives an empty result. Extra columns of any
name are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import ascii_lower, free_names, written

SUPPORT = 0.001


def _text_key(docs: DataFrame, text_col: str):
    return F.sha2(ascii_lower(docs[text_col]), 256)


def copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = written(
        docs.select(
            docs[id_col].alias("doc_id"), _text_key(docs, text_col).alias("text_sha256")
        ).withColumn("row_no", F.monotonically_increasing_id()),
        "dedup-keys",
    )
    winner = [
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("doc_id", "row_no")).alias("winner"),
    ]
    frequent = keys.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    floor = max(2.0, support * keys.count())
    heavy = written(
        keys.join(F.broadcast(frequent), "text_sha256")
        .groupBy("text_sha256")
        .agg(*winner)
        .where(F.col("group_size") >= floor),
        "dedup-heavy",
    )
    rest = keys.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    settled = keys.join(F.broadcast(heavy), "text_sha256").unionByName(
        rest.join(rest.groupBy("text_sha256").agg(*winner), "text_sha256")
    )
    return settled.select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("winner.row_no")).alias("kept"),
        "text_sha256",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts are joined once, with the keys of rows that go and of winners that the table
    repeats; of the latter, equal in id and text, one row stays.
    """
    key, id_, same, kept = free_names(docs.columns, "_text_key", "_touched_id", "_touched_key", "_touched_kept")
    decided = written(copy_groups(docs, id_col, text_col, support), "dedup-decided")
    touched = (
        decided.where(F.col("group_size") > 1)
        .groupBy("doc_id", "text_sha256")
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where(~F.col("kept") | (F.col("n") > 1))
        .select(
            F.col("doc_id").alias(id_),
            F.col("text_sha256").alias(same),
            F.col("kept").alias(kept),
        )
    )
    marked = docs.withColumn(key, _text_key(docs, text_col)).join(
        touched, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(key) == F.col(same)), "left"
    )
    single = marked.where(F.col(kept).isNull())
    if touched.where(F.col(kept)).isEmpty():
        return single.select(*docs.columns)
    repeated = marked.where(F.col(kept)).dropDuplicates([id_col, key])
    return single.unionByName(repeated).select(*docs.columns)
