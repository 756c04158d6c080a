"""Rows by their place in a stored table, for tables that share an order but no key.

A scan reads a file in splits, which Spark deals to tasks by size. The place of a row follows
from its split: the rows of all splits before it, by file name and start, and its own place in
the split. Only counts per split are added up, one row for each; no row is ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsieve.session import written


def with_position(frame: DataFrame, name: str = "position") -> DataFrame:
    """A stored copy of ``frame`` with the place of each row, from 0: files in the order of their
    names, rows in the order of their file. ``frame`` must be a plain read of files.

    Splits may differ from one scan to the next, so the table is scanned once: the places come
    from what that scan stored.
    """
    scanned = frame.select(
        *frame.columns,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        ).alias("_split"),
        F.monotonically_increasing_id().alias("_scanned"),
    )
    stored = written(scanned, "scanned-rows")
    splits = stored.groupBy("_split").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_scanned").alias("_first")
    )
    # One row per split of an input file.
    ahead = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_split", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")
    )
    return stored.join(offsets, "_split").select(
        *frame.columns, (F.col("_before") + F.col("_scanned") - F.col("_first")).alias(name)
    )


def align_by_position(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """Rows of two reads of files side by side, first to first. Unequal lengths are an error.

    Both tables must have columns of different names.
    """
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"columns of the same name in both tables: {sorted(shared)}")
    numbered = [written(with_position(table, position), "by-position") for table in (left, right)]
    sizes = [table.count() for table in numbered]
    if sizes[0] != sizes[1]:
        raise ValueError(f"the tables have {sizes[0]} and {sizes[1]} rows")
    return numbered[0].join(numbered[1], position)
