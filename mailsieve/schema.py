"""Column layout of the message table and checks on column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The standard column names and their order.
STANDARD_COLUMNS = ["source", "file_name", "label", "label_name", "subject", "text"]
REQUIRED_COLUMNS = ["label", "text"]

ROW_KEY = "row_index"

#: A cleaned message.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(ROW_KEY, T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("label_name", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def text_columns(names: Iterable[str]) -> T.StructType:
    """All columns as text: a file before its values were checked."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def missing_columns(frame: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name not in frame.columns]


def require_columns(frame: DataFrame, names: Iterable[str]) -> None:
    missing = missing_columns(frame, names)
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def text_column_by_suffix(frame: DataFrame) -> str:
    """First column called ``text`` or ending in ``_text``, any case."""
    for name in frame.columns:
        if name.lower() == "text" or name.lower().endswith("_text"):
            return name
    raise ValueError("no text column found")


def text_column_by_preference(frame: DataFrame) -> str:
    """``text``, else ``email``, else ``content``, else the first non-label column."""
    for name in ("text", "email", "content"):
        if name in frame.columns:
            return name
    others = [name for name in frame.columns if name != "label"]
    if not others:
        raise ValueError("no text column found")
    return others[0]
