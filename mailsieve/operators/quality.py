"""Audit, filter and summary of labelled messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions.labels import is_valid_label, label_name
from mailsieve.functions.text import strip
from mailsieve.operators.dedupe import first_rows, keep_first, mark_duplicates, text_digest
from mailsieve.schema import REQUIRED_COLUMNS, ROW_KEY, missing_columns

# The rule names, in report order.
ISSUES = ["invalid_label", "empty_text", "short_text", "duplicate_label_text"]


def row_rules(min_length: int = settings.MIN_TEXT_LENGTH) -> dict[str, Column]:
    """The rules a row can break on its own."""
    length = F.length(strip(F.col("text")))
    return {
        "invalid_label": ~is_valid_label(F.col("label")),
        "empty_text": length == 0,
        "short_text": length < min_length,
    }


def flag_rows(
    frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH, row_key: str = ROW_KEY
) -> DataFrame:
    """Add one flag per rule: the table from which audit, filter and counts follow.

    The only join of full rows is the one with the keys of later copies.
    """
    flagged = frame.withColumns(row_rules(min_length))
    return mark_duplicates(flagged, "duplicate_label_text", row_key=row_key)


def issues_of(flagged: DataFrame, row_key: str = ROW_KEY) -> DataFrame:
    """One record per row and broken rule of a flagged table."""
    broken = F.array_compact(F.array(*(F.when(F.col(name), F.lit(name)) for name in ISSUES)))
    return flagged.select(
        F.explode(broken).alias("issue"),
        F.col(row_key).alias(ROW_KEY),
        "source",
        "file_name",
        "label",
        "label_name",
        "text",
    )


def clean_of(flagged: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH) -> DataFrame:
    """The rows of a flagged table that are usable and first of their copies.

    Rows of equal label and text pass or fail the other rules together, so the first of
    all copies is the first of the usable ones.
    """
    kept = usable_rows(flagged, min_length).filter(~F.col("duplicate_label_text"))
    return with_final_labels(kept.drop(*ISSUES))


def find_issues(
    frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH, row_key: str = ROW_KEY
) -> DataFrame:
    """One record per row and broken rule, from one pass over the rows."""
    return issues_of(flag_rows(frame, min_length, row_key), row_key)


def issue_counts(frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH) -> DataFrame:
    """Number of records per issue, without building the issue table.

    A group of n equal rows holds n - 1 later copies, so one aggregate that
    combines before its shuffle gives all four counts.
    """
    rules = row_rules(min_length)
    groups = (
        frame.withColumns(rules)
        .groupBy("label", text_digest(F.col("text")).alias("text_digest"))
        .agg(
            *(F.count_if(F.col(name)).alias(name) for name in rules),
            (F.count(F.lit(1)) - 1).alias("duplicate_label_text"),
        )
    )
    totals = groups.agg(*(F.sum(name).alias(name) for name in ISSUES))
    cells = F.array(*(F.struct(F.lit(n).alias("issue"), F.col(n).alias("n")) for n in ISSUES))
    return totals.select(F.inline(cells)).filter(F.col("n") > 0)


def usable_rows(frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH) -> DataFrame:
    """Rows with a known label and a text of at least ``min_length`` characters."""
    return frame.filter(F.col("label").isin(*settings.LABELS) & (F.length("text") >= min_length))


def with_final_labels(frame: DataFrame) -> DataFrame:
    label = F.col("label").cast("int")
    return frame.withColumns({"label": label, "label_name": label_name(label)})


def clean_messages(
    frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH, row_key: str = ROW_KEY
) -> DataFrame:
    """Usable rows, first copy only, with integer labels and their names."""
    return with_final_labels(keep_first(usable_rows(frame, min_length), row_key=row_key))


def clean_keys(
    frame: DataFrame, min_length: int = settings.MIN_TEXT_LENGTH, row_key: str = ROW_KEY
) -> DataFrame:
    """Label and row key of every row ``clean_messages`` keeps, without its join."""
    firsts = first_rows(usable_rows(frame, min_length), row_key=row_key)
    return firsts.select(F.col("label").cast("int").alias("label"), row_key)


def label_counts(frame: DataFrame) -> DataFrame:
    return frame.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def quality_summary(
    raw: DataFrame,
    clean: DataFrame,
    issues: DataFrame,
    kept: DataFrame | None = None,
    input_path: str = "",
    output_path: str = "",
) -> DataFrame:
    """One row of counts before and after cleaning.

    ``issues`` has one row per issue and its count ``n``. ``kept`` is the table
    before balancing; with it ``filtered_rows`` tells how many rows broke a rule.
    """
    parts = [("input", label_counts(raw)), ("clean", label_counts(clean))]
    if kept is not None:
        parts.append(("kept", label_counts(kept)))
    cells = issues.select(F.lit("issue").alias("part"), F.col("issue").alias("key"), "n")
    # A label column may hold anything: the maps list the known labels and one sum of the rest.
    label = F.col("label").cast("double")
    key = F.when(is_valid_label(label), label.cast("long").cast("string")).when(
        label.isNotNull(), F.lit("other")
    )
    for part, counts in parts:
        known = counts.groupBy(key.alias("key")).agg(F.sum("n").alias("n"))
        cells = cells.unionByName(known.select(F.lit(part).alias("part"), "key", "n"))

    def total(part: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("part") == part, F.col("n"))), F.lit(0))

    def as_map(part: str) -> Column:
        # At most four entries. Rows without a label count towards the totals only.
        entry = F.when((F.col("part") == part) & F.col("key").isNotNull(), F.struct("key", "n"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry)))

    return cells.agg(
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("clean_output_path"),
        total("input").alias("input_rows"),
        total("clean").alias("clean_rows"),
        (total("input") - total("clean")).alias("removed_rows"),
        as_map("input").alias("input_label_counts"),
        as_map("clean").alias("clean_label_counts"),
        as_map("issue").alias("issue_counts"),
        F.lit(not missing_columns(raw, REQUIRED_COLUMNS)).alias("required_columns_present"),
        *([(total("input") - total("kept")).alias("filtered_rows")] if kept is not None else []),
    )


def rule_violations(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: number of rows, and for each rule the rows that break it."""
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"violations_{name}")
            for name, rule in rules.items()
        ),
    )


def require_quality(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The table itself, or an error that names the broken rules and how often."""
    found = rule_violations(frame, rules).first().asDict()
    broken = {name: found[f"violations_{name}"] for name in rules if found[f"violations_{name}"]}
    if broken:
        raise ValueError(f"quality rules broken: {broken}")
    return frame
