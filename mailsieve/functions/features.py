"""Hand-made features of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions import patterns as P
from mailsieve.functions.text import as_text

MANUAL_FEATURES = [
    "length",
    "url_count",
    "exclamation_count",
    "dollar_count",
    "uppercase_ratio",
]


def text_length(text: Column) -> Column:
    """Number of code points."""
    return F.length(text)


def url_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(P.URL_MARK))


def character_count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def uppercase_count(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, P.UPPERCASE_RUN, ""))


def uppercase_ratio(text: Column) -> Column:
    return uppercase_count(text) / (F.length(text) + 1)


def with_manual_features(frame: DataFrame, text_col: str = "text") -> DataFrame:
    text = as_text(F.col(text_col))
    return frame.withColumns(
        {
            "length": text_length(text).cast("int"),
            "url_count": url_count(text).cast("int"),
            "exclamation_count": character_count(text, "!").cast("int"),
            "dollar_count": character_count(text, "$").cast("int"),
            "uppercase_ratio": uppercase_ratio(text),
        }
    )
