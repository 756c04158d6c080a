"""Evaluation of stored predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from mailsieve.operators.evaluation import (
    compare_models,
    confusion_counts,
    confusion_long,
    long_predictions,
    metrics_from_cells,
)
from mailsieve.schema import text_columns
from mailsieve.session import written
from mailsieve.sources.readers import read_csv
from mailsieve.sources.sinks import write_csv, write_json


def run_evaluation_job(
    spark: SparkSession,
    predictions_path: str,
    true_col: str,
    pred_cols: Sequence[str],
    output_folder: str,
) -> DataFrame:
    """Compare all prediction columns of a CSV; store the comparison and the matrices.

    The file is read once: everything else follows from the four cells per model.
    """
    schema = text_columns(spark.read.option("header", True).csv(predictions_path).columns)
    table = read_csv(spark, predictions_path, schema, multi_line=False)
    predictions = long_predictions(table, true_col, pred_cols)
    cells = written(confusion_counts(predictions), "confusion-cells")
    comparison = compare_models(metrics_from_cells(cells))
    write_csv(comparison, f"{output_folder}/model_comparison", single_file=True)
    write_json(comparison, f"{output_folder}/model_metrics")
    write_csv(confusion_long(cells), f"{output_folder}/confusion_matrix", single_file=True)
    return comparison
