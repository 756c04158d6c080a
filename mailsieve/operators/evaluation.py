"""Confusion counts, metrics and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.labels import label_from_word
from mailsieve.functions.numeric import round_half_even, safe_divide
from mailsieve.operators.running import totals_before
from mailsieve.schema import require_columns
from mailsieve.session import written

# Ranking order of the metric table.
RANKING = ["f1_spam", "recall_spam", "precision_spam"]
CELLS = [("TN", 0, 0, "tn"), ("FP", 0, 1, "fp"), ("FN", 1, 0, "fn"), ("TP", 1, 1, "tp")]


def long_predictions(
    frame: DataFrame, true_col: str, pred_cols: Sequence[str], strict: bool = True
) -> DataFrame:
    """Wide table, one column per model, to rows of model, label and prediction."""
    require_columns(frame, [true_col, *pred_cols])
    wide = frame.select(
        label_from_word(F.col(true_col), strict).alias("label"),
        *(label_from_word(F.col(name), strict).alias(name) for name in pred_cols),
    )
    return wide.unpivot("label", list(pred_cols), "model", "prediction")


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """The four cells per model."""
    return predictions.groupBy("model").agg(
        *(
            F.count_if((F.col("label") == truth) & (F.col("prediction") == guess)).alias(name)
            for _, truth, guess, name in CELLS
        )
    )


def metrics_from_cells(cells: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(name) for _, _, _, name in CELLS)
    measured = cells.withColumns(
        {
            "total": tn + fp + fn + tp,
            "precision_spam": safe_divide(tp, tp + fp),
            "recall_spam": safe_divide(tp, tp + fn),
        }
    )
    precision, recall = F.col("precision_spam"), F.col("recall_spam")
    return measured.select(
        "model",
        safe_divide(tp + tn, F.col("total")).alias("accuracy"),
        "precision_spam",
        "recall_spam",
        safe_divide(2 * precision * recall, precision + recall).alias("f1_spam"),
        safe_divide(fp, fp + tn).alias("false_positive_rate"),
        "tn",
        "fp",
        "fn",
        "tp",
        "total",
    )


def model_metrics(predictions: DataFrame) -> DataFrame:
    return metrics_from_cells(confusion_counts(predictions))


def lenient_metrics(frame: DataFrame, true_col: str, pred_cols: Sequence[str]) -> DataFrame:
    """Metrics over the rows with two known labels, and ``unparsed``: how many have not."""
    predictions = long_predictions(frame, true_col, pred_cols, strict=False)
    unknown = F.col("label").isNull() | F.col("prediction").isNull()
    counted = predictions.groupBy("model").agg(F.count_if(unknown).alias("unparsed"))
    return model_metrics(predictions).join(counted, "model")  # one row per model


def compare_models(metrics: DataFrame) -> DataFrame:
    """Best model first; sort columns that are absent are skipped."""
    order = [F.desc(name) for name in RANKING if name in metrics.columns]
    return metrics.orderBy(*order, "model")


def best_model(metrics: DataFrame) -> DataFrame:
    return compare_models(metrics).limit(1)


def evaluate_columns(frame: DataFrame, true_col: str, pred_cols: Sequence[str]) -> DataFrame:
    """Compared metrics of any number of prediction columns, from one aggregate."""
    return compare_models(model_metrics(long_predictions(frame, true_col, pred_cols)))


def quality_gate(metrics: DataFrame, min_f1: float = 0.90, min_recall: float = 0.90) -> DataFrame:
    """Whether the best model reaches both thresholds."""
    passed = (F.col("f1_spam") >= min_f1) & (F.col("recall_spam") >= min_recall)
    return best_model(metrics).select("model", "f1_spam", "recall_spam", passed.alias("passed"))


def confusion_long(cells: DataFrame) -> DataFrame:
    """The 2 x 2 matrix as rows, empty cells included."""
    rows = F.array(
        *(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(cell).alias("cell"),
                F.lit("spam" if truth else "not spam").alias("true_label"),
                F.lit("spam" if guess else "not spam").alias("predicted_label"),
                F.col(name).alias("n"),
            )
            for position, (cell, truth, guess, name) in enumerate(CELLS)
        )
    )
    return cells.select("model", F.inline(rows))


def plain_accuracy(frame: DataFrame, true_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    hit = (F.col(true_col) == F.col(pred_col)).cast("int")
    return frame.agg(F.avg(hit).alias("accuracy"))


def align_predictions(truth: DataFrame, predictions: DataFrame, row_key: str) -> DataFrame:
    """Join labels and predictions on the row key."""
    return truth.join(predictions, row_key, "inner")


def alignment_gaps(truth: DataFrame, predictions: DataFrame, row_key: str) -> DataFrame:
    """One row: matched keys, and keys found on one side only."""
    left = truth.select(row_key).withColumn("_truth", F.lit(True))
    right = predictions.select(row_key).withColumn("_prediction", F.lit(True))
    both = left.join(right, row_key, "full_outer")
    has_truth, has_prediction = F.col("_truth").isNotNull(), F.col("_prediction").isNotNull()
    return both.agg(
        F.count_if(has_truth & has_prediction).alias("matched"),
        F.count_if(has_truth & ~has_prediction).alias("without_prediction"),
        F.count_if(~has_truth & has_prediction).alias("without_truth"),
    )


def require_aligned(truth: DataFrame, predictions: DataFrame, row_key: str) -> None:
    gaps = alignment_gaps(truth, predictions, row_key).first()
    if gaps["without_prediction"] or gaps["without_truth"]:
        raise ValueError(f"labels and predictions have different rows: {gaps.asDict()}")


def roc_auc(frame: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Area under the ROC curve; equal scores count half. Null if a class is absent."""
    by_score = frame.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(F.col(label_col) == 1).alias("spam"),
        F.count_if(F.col(label_col) == 0).alias("ham"),
    )
    # Stored: the running totals read it three times, and it is all they need.
    ranked = totals_before(written(by_score, "score-counts"), "score", ["ham"])
    won = F.col("spam").cast("double") * (F.col("ham_before") + F.col("ham") / 2.0)
    sums = ranked.agg(
        F.sum(won).alias("won"), F.sum("spam").alias("n_spam"), F.sum("ham").alias("n_ham")
    )
    pairs = F.col("n_spam").cast("double") * F.col("n_ham")
    return sums.select(
        "n_spam", "n_ham", round_half_even(F.col("won") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc")
    )
