"""Bring any labelled table to the standard message columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mailsieve.functions.labels import label_name, numeric_label
from mailsieve.functions.text import strip
from mailsieve.schema import ROW_KEY, STANDARD_COLUMNS


def normalise_messages(frame: DataFrame, row_key: str = ROW_KEY) -> DataFrame:
    """Row key plus the six standard columns.

    Missing columns are empty strings, labels are numbers or null, texts are
    stripped and never null, and known labels get their name.
    """
    present = {
        name: F.col(name) if name in frame.columns else F.lit("") for name in STANDARD_COLUMNS
    }
    # A label stored as a number is compared as it is, so that filters reach the scan.
    label_type = frame.select(present["label"]).schema[0].dataType
    is_number = isinstance(label_type, NumericType)
    label = present["label"].cast("double") if is_number else numeric_label(present["label"])
    fields = {
        **present,
        "label": label,
        "label_name": label_name(label, fallback=present["label_name"]),
        "text": strip(present["text"]),
    }
    return frame.select(row_key, *(value.alias(name) for name, value in fields.items()))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources, matched by column name."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged
