"""Writers for tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(frame: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header and doubled quotes. ``single_file`` is for small reports."""
    table = frame.coalesce(1) if single_file else frame
    table.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def write_json(frame: DataFrame, path: str) -> str:
    """A report of one or a few rows as JSON."""
    frame.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_table(frame: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Parquet table; one folder per value of ``partition_by``.

    Rows are brought together by that value first, so that a folder gets few files;
    adaptive execution splits a value that is too large for one.
    """
    if partition_by is not None:
        frame = frame.hint("rebalance", partition_by)
    writer = frame.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path
