"""End-to-end cleaning: audit, filter, dedupe, balance, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions.text import with_clean_text
from mailsieve.operators.normalise import normalise_messages
from mailsieve.operators.quality import clean_of, flag_rows, issues_of, quality_summary
from mailsieve.operators.sampling import balance_classes, shuffled
from mailsieve.schema import ROW_KEY, require_columns, text_column_by_suffix
from mailsieve.session import written
from mailsieve.sources.sinks import write_json, write_table


@dataclass(frozen=True)
class QualityTables:
    clean: DataFrame
    issues: DataFrame
    summary: DataFrame


def run_quality_job(
    messages: DataFrame,
    output_folder: str,
    input_path: str = "",
    min_length: int = settings.MIN_TEXT_LENGTH,
    seed: int = settings.SEED,
    row_key: str = ROW_KEY,
    shuffle_rows: bool = False,
) -> QualityTables:
    """Write the balanced clean table, the issue table and the summary.

    The normalised rows are flagged and stored once; issues, clean rows and counts
    all come from that table without another join.
    """
    spark = messages.sparkSession
    normal = normalise_messages(messages, row_key)
    flagged = written(flag_rows(normal, min_length, row_key), "flagged-messages")

    issues_path = f"{output_folder}/issues"
    write_table(issues_of(flagged, row_key), issues_path)
    issues = spark.read.parquet(issues_path)

    kept = clean_of(flagged, min_length)
    keys = written(kept.select("label", row_key), "kept-keys")
    balanced = balance_classes(kept, row_key=row_key, seed=seed, keys=keys)
    clean_path = f"{output_folder}/clean"
    write_table(shuffled(balanced, row_key, seed) if shuffle_rows else balanced, clean_path)
    clean = spark.read.parquet(clean_path)

    counts = issues.groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
    report = quality_summary(flagged, clean, counts, keys, input_path, clean_path)
    report_path = f"{output_folder}/summary"
    write_json(report, report_path)
    return QualityTables(clean, issues, spark.read.schema(report.schema).json(report_path))


def read_quality_tables(spark: SparkSession, output_folder: str) -> QualityTables:
    """The tables that ``run_quality_job`` left in a folder."""
    clean = spark.read.parquet(f"{output_folder}/clean")
    # A report's schema does not depend on its rows.
    report = quality_summary(clean, clean, clean.select(F.lit("").alias("issue"), F.lit(0).cast("long").alias("n")), clean)
    return QualityTables(
        clean, spark.read.parquet(f"{output_folder}/issues"), spark.read.schema(report.schema).json(f"{output_folder}/summary")
    )


def preprocess_texts(
    frame: DataFrame,
    text_col: str | None = None,
    output_col: str = "clean_text",
    min_text_length: int = 0,
) -> DataFrame:
    """Add the cleaned text; drop rows whose cleaned text is too short, if asked."""
    text_col = text_column_by_suffix(frame) if text_col is None else text_col
    require_columns(frame, [text_col])
    cleaned = with_clean_text(frame, text_col, output_col)
    if min_text_length > 0:
        cleaned = cleaned.filter(F.length(output_col) >= min_text_length)
    return cleaned


def run_preprocessing_job(
    frame: DataFrame, output_folder: str, input_path: str = "", text_col: str | None = None
) -> DataFrame:
    """Distinct rows with a text, cleaned and stored, with a metadata report."""
    spark = frame.sparkSession
    text_col = text_column_by_suffix(frame) if text_col is None else text_col
    rows = frame.distinct().filter(F.col(text_col).isNotNull())
    output_path = f"{output_folder}/preprocessed"
    write_table(preprocess_texts(rows, text_col), output_path)
    stored = spark.read.parquet(output_path)
    # No row is dropped between the two counts when no minimum length is set.
    metadata = stored.agg(
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("output_path"),
        F.count(F.lit(1)).alias("n_rows_input"),
        F.count(F.lit(1)).alias("n_rows_output"),
        F.lit(text_col).alias("text_column"),
    )
    write_json(metadata, f"{output_folder}/metadata")
    return stored
