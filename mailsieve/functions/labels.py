"""Label parsing and naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailsieve.functions.patterns import WHITESPACE
from mailsieve.settings import LABELS

# Spellings of the two classes.
SPAM_WORDS = ["1", "spam", "true", "malicious", "phish", "phishing"]
HAM_WORDS = ["0", "ham", "not spam", "not_spam", "false", "normal"]

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def numeric_label(value: Column) -> Column:
    """The label as double; null where it is not a plain number."""
    text = F.btrim(value.cast("string"), F.lit(WHITESPACE))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_valid_label(label: Column) -> Column:
    """True for the two known classes, false for anything else, null included."""
    return F.coalesce(label.isin(*LABELS), F.lit(False))


def label_name(label: Column, fallback: Column | None = None) -> Column:
    named = F.when(label == 0, F.lit("ham")).when(label == 1, F.lit("spam"))
    return named if fallback is None else F.coalesce(named, fallback)


def display_name(label: Column) -> Column:
    """Class name as shown in prediction results."""
    return F.when(label == 1, F.lit("spam")).when(label == 0, F.lit("not spam"))


def merge_phishing(label: Column) -> Column:
    """Three classes to two: 0 stays ham, 1 and 2 become spam, others are null."""
    return F.when(label == 0, F.lit(0)).when(label.isin(1, 2), F.lit(1))


def label_from_word(value: Column, strict: bool = True) -> Column:
    """0 or 1 from any accepted spelling.

    Unknown spellings raise an error, or become null with ``strict=False``.
    """
    word = F.lower(F.btrim(value.cast("string"), F.lit(WHITESPACE)))
    known = F.when(word.isin(SPAM_WORDS), F.lit(1)).when(word.isin(HAM_WORDS), F.lit(0))
    if not strict:
        return known
    message = F.concat(F.lit("unknown label: "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.coalesce(known, F.raise_error(message).cast("int"))
