"""Text cleaning as column expressions; no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions import patterns as P
from mailsieve.functions.entities import decode_entities


def as_text(value: Column) -> Column:
    """The value as string, null as the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(as_text(value), F.lit(P.WHITESPACE))


def preview(value: Column, size: int = 80) -> Column:
    return F.substring(value, 1, size)


def without_blocks(value: Column) -> Column:
    """Script and style blocks become one blank each."""
    text = as_text(value)
    no_script = F.regexp_replace(text, P.SCRIPT_BLOCK, " ")
    replaced = F.regexp_replace(no_script, P.STYLE_BLOCK, " ")
    return F.when(text.contains("</"), replaced).otherwise(text)


def without_tags(value: Column) -> Column:
    """Each tag becomes one blank.

    Nothing after the last ``>`` can be part of a tag; leaving that end out keeps
    the search linear on texts with many opening brackets.
    """
    text = as_text(value)
    end = F.substring_index(text, ">", -1)
    start = F.substring(text, F.lit(1), F.length(text) - F.length(end))
    tagged = F.concat(F.regexp_replace(start, P.TAG, " "), end)
    return F.when(text.contains(">"), tagged).otherwise(text)


def without_urls(value: Column) -> Column:
    text = as_text(value)
    lower = F.lower(text)
    may_hold_url = lower.contains("http") | lower.contains("www.")
    return F.when(may_hold_url, F.regexp_replace(text, P.URL, P.URL_TOKEN)).otherwise(text)


def without_addresses(value: Column) -> Column:
    text = as_text(value)
    return F.when(text.contains("@"), F.regexp_replace(text, P.EMAIL, P.EMAIL_TOKEN)).otherwise(text)


def without_numbers(value: Column) -> Column:
    return F.regexp_replace(as_text(value), P.DIGITS, P.NUMBER_TOKEN)


def letters_only(value: Column) -> Column:
    """Lower case; everything but a-z collapses to single blanks; stripped."""
    return F.trim(F.regexp_replace(F.lower(as_text(value)), P.NOT_LETTERS, " "))


def stopword_list(language: str = "short", extra: Iterable[str] = ()) -> list[str]:
    """``short``: 29 English words; else the list of that language that ships with Spark."""
    if language == "short":
        words = list(P.SHORT_STOPWORDS)
    elif language in P.STOPWORD_LANGUAGES:
        words = list(StopWordsRemover.loadDefaultStopWords(language))
    else:
        raise ValueError(f"unknown stop-word list: {language}")
    return words + [word.lower() for word in extra]


def _drop_words(text: Column, words: list[str]) -> Column:
    kept = F.filter(F.split(text, " "), lambda word: (word != "") & ~word.isin(words))
    return F.array_join(kept, " ")


def kept_letter_words(value: Column, words: list[str]) -> Column:
    """``letters_only`` without the stop words: runs of a-z are taken out, not all else replaced."""
    runs = F.regexp_extract_all(F.lower(as_text(value)), F.lit(P.LETTERS), F.lit(0))
    return F.array_join(F.filter(runs, lambda word: ~word.isin(words)), " ")


def without_stopwords(value: Column, words: Iterable[str] | None = None) -> Column:
    """Words between white space of any kind, without the stop words, one blank apart."""
    blanks = F.translate(as_text(value), P.WHITESPACE, " " * len(P.WHITESPACE))
    return _drop_words(blanks, list(P.SHORT_STOPWORDS if words is None else words))


Step = Callable[[Column], Column]

MARKUP_STEPS: tuple[Step, ...] = (as_text, without_blocks, without_tags, decode_entities)
# The order matters: a URL may hold an address, and both may hold digits.
TOKEN_STEPS: tuple[Step, ...] = (without_urls, without_addresses, without_numbers)


def with_steps(
    frame: DataFrame, text_col: str, output_col: str, steps: Iterable[Step]
) -> DataFrame:
    """Apply text functions one after the other.

    Some of them read their input more than once. As a column of its own each
    result is computed once; the optimiser merges the steps that can be merged.
    """
    frame = frame.withColumn(output_col, F.col(text_col))
    for step in steps:
        frame = frame.withColumn(output_col, step(F.col(output_col)))
    return frame


def with_plain_text(frame: DataFrame, text_col: str, output_col: str = "plain_text") -> DataFrame:
    """Add the text without markup and with character references decoded."""
    return with_steps(frame, text_col, output_col, MARKUP_STEPS)


def with_entity_tokens(frame: DataFrame, text_col: str, output_col: str) -> DataFrame:
    """Add the text with tokens in place of URLs, e-mail addresses and numbers."""
    return with_steps(frame, text_col, output_col, TOKEN_STEPS)


def with_clean_text(
    frame: DataFrame,
    text_col: str = "text",
    output_col: str = "clean_text",
    remove_common_words: bool = True,
    stopwords: Iterable[str] | None = None,
) -> DataFrame:
    """Add the cleaned text: no markup, entity tokens, letters only, no stop words."""
    last = letters_only
    if remove_common_words:
        words = list(P.SHORT_STOPWORDS if stopwords is None else stopwords)
        last = partial(kept_letter_words, words=words)
    return with_steps(frame, text_col, output_col, [*MARKUP_STEPS, *TOKEN_STEPS, last])
