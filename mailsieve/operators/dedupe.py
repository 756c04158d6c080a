"""First-row-wins duplicate handling.

Groups of equal rows are found on a hash of the text with a plain aggregate, so a
group that holds a third of all rows shrinks to one record per task before the
shuffle. Only groups with later copies go on: their rows are found by a join of narrow
records, and the copies, usually few, meet the full rows in one join on the unique row
key. How that join is done is left to adaptive execution, which measures both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.text import as_text
from mailsieve.schema import ROW_KEY


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(as_text(text), 256))


def first_rows(
    frame: DataFrame,
    keys: Sequence[str] = ("label",),
    text_col: str = "text",
    row_key: str = ROW_KEY,
) -> DataFrame:
    """One narrow record per group of equal rows: keys, first row key, copies."""
    return (
        frame.groupBy(*keys, text_digest(F.col(text_col)).alias("text_digest"))
        .agg(F.min(row_key).alias(row_key), F.count(F.lit(1)).alias("copies"))
        .select(*keys, row_key, "copies")
    )


def duplicate_keys(
    frame: DataFrame,
    keys: Sequence[str] = ("label",),
    text_col: str = "text",
    row_key: str = ROW_KEY,
) -> DataFrame:
    """Row keys of all later copies. No join side holds a text."""
    group = F.struct(*keys, text_digest(F.col(text_col)).alias("text_digest"))
    narrow = frame.select(F.col(row_key).alias("_key"), F.xxhash64(group).alias("_hash"), group.alias("_group"))
    firsts = (
        narrow.groupBy("_hash", "_group")
        .agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select(F.col("_hash").alias("_of_hash"), F.col("_group").alias("_of_group"), "_first")
    )
    # The hash of the group is never null, its fields may be: labels can be unknown.
    same = (F.col("_hash") == F.col("_of_hash")) & F.col("_group").eqNullSafe(F.col("_of_group"))
    later = narrow.join(firsts, same & (F.col("_key") > F.col("_first")), "left_semi")
    return later.select(F.col("_key").alias(row_key))


def keep_first(
    frame: DataFrame,
    keys: Sequence[str] = ("label",),
    text_col: str = "text",
    row_key: str = ROW_KEY,
) -> DataFrame:
    """Keep the lowest row key of each group of equal rows."""
    return frame.join(duplicate_keys(frame, keys, text_col, row_key), row_key, "left_anti")


def mark_duplicates(
    frame: DataFrame,
    flag: str = "is_duplicate",
    keys: Sequence[str] = ("label",),
    text_col: str = "text",
    row_key: str = ROW_KEY,
) -> DataFrame:
    """Add a flag that is true on every copy but the first."""
    later = duplicate_keys(frame, keys, text_col, row_key).withColumn(flag, F.lit(True))
    return frame.join(later, row_key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def distinct_rows(frame: DataFrame) -> DataFrame:
    """Whole-row distinct; equal rows are interchangeable."""
    return frame.distinct()
