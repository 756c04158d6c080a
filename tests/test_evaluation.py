import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from mailsieve.functions import numeric
from mailsieve.operators import evaluation

# Published results and the cells behind them.
KNOWN = {
    "linear_svm": ((5874, 126, 124, 5876), (0.979167, 0.979007, 0.979333, 0.97917)),
    "logistic_regression": ((5821, 179, 133, 5867), (0.974, 0.970394, 0.977833, 0.974099)),
    "naive_bayes": ((5868, 132, 307, 5693), (0.963417, 0.977339, 0.948833, 0.962875)),
}


def test_small_example(spark):
    pairs = list(zip([0, 0, 1, 1, 1], [0, 1, 1, 0, 1], strict=True))
    frame = spark.createDataFrame(pairs, "label int, m int")
    row = evaluation.evaluate_columns(frame, "label", ["m"]).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"], row["total"]) == (1, 1, 1, 2, 5)
    assert row["accuracy"] == pytest.approx(0.6)
    for name in ("precision_spam", "recall_spam", "f1_spam"):
        assert row[name] == pytest.approx(2 / 3)
    assert row["false_positive_rate"] == pytest.approx(0.5)
    assert evaluation.plain_accuracy(frame, "label", "m").first()[0] == pytest.approx(0.6)


def test_known_matrices(spark):
    cells = spark.createDataFrame(
        [(name, *cells) for name, (cells, _) in KNOWN.items()],
        "model string, tn long, fp long, fn long, tp long",
    )
    rows = evaluation.compare_models(evaluation.metrics_from_cells(cells)).collect()
    assert [r["model"] for r in rows] == ["linear_svm", "logistic_regression", "naive_bayes"]
    for row in rows:
        measured = [row[n] for n in ("accuracy", "precision_spam", "recall_spam", "f1_spam")]
        assert measured == pytest.approx(KNOWN[row["model"]][1], abs=5e-7)
    metrics = evaluation.metrics_from_cells(cells)
    assert evaluation.best_model(metrics).first()["model"] == "linear_svm"
    assert evaluation.quality_gate(metrics).first()["passed"] is True
    assert evaluation.quality_gate(metrics, min_f1=0.99).first()["passed"] is False


def test_empty_denominators(spark):
    frame = spark.createDataFrame([("ham", "0"), ("normal", "false")], "label string, m string")
    row = evaluation.evaluate_columns(frame, "label", ["m"]).first()
    assert row["accuracy"] == 1.0
    assert row["precision_spam"] == row["recall_spam"] == row["f1_spam"] == 0.0


def test_unknown_labels_and_columns_raise(spark):
    frame = spark.createDataFrame([("ham", "what")], "label string, m string")
    with pytest.raises(Exception, match="unknown label"):
        evaluation.evaluate_columns(frame, "label", ["m"]).collect()
    with pytest.raises(ValueError, match="absent"):
        evaluation.evaluate_columns(frame, "label", ["absent"])


def test_compare_skips_absent_columns(spark):
    frame = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "model string, f1_spam double")
    assert [r["model"] for r in evaluation.compare_models(frame).collect()] == ["b", "a"]
    assert evaluation.compare_models(frame.limit(0)).count() == 0


def test_confusion_rows_include_empty_cells(spark):
    cells = spark.createDataFrame([("m", 3, 0, 0, 2)], "model string, tn long, fp long, fn long, tp long")
    rows = evaluation.confusion_long(cells).orderBy("position").collect()
    assert [(r["cell"], r["n"]) for r in rows] == [("TN", 3), ("FP", 0), ("FN", 0), ("TP", 2)]
    assert rows[1]["true_label"] == "not spam" and rows[1]["predicted_label"] == "spam"


def test_evaluation_job(spark, tmp_path):
    from mailsieve.plans.evaluation_job import run_evaluation_job

    path = tmp_path / "p.csv"
    path.write_text("label,nb,svm\n0,0,ham\n0,1,ham\n1,1,spam\n1,0, Spam\n1,1,phish\n")
    out = str(tmp_path / "out")
    rows = run_evaluation_job(spark, str(path), "label", ["nb", "svm"], out).collect()
    assert [(r["model"], r["tp"], r["fp"]) for r in rows] == [("svm", 3, 0), ("nb", 2, 1)]
    stored = spark.read.option("header", True).csv(f"{out}/model_comparison").collect()
    assert [r["model"] for r in stored] == ["svm", "nb"]
    assert spark.read.json(f"{out}/model_metrics").count() == 2
    assert spark.read.option("header", True).csv(f"{out}/confusion_matrix").count() == 8
    with pytest.raises(ValueError):
        run_evaluation_job(spark, str(path), "label", ["absent"], out)


def test_alignment(spark):
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "k int, label int")
    guess = spark.createDataFrame([(2, 1), (3, 0), (4, 1)], "k int, prediction int")
    gaps = evaluation.alignment_gaps(truth, guess, "k").first()
    assert tuple(gaps) == (2, 1, 1)
    assert evaluation.align_predictions(truth, guess, "k").count() == 2
    with pytest.raises(ValueError, match="different rows"):
        evaluation.require_aligned(truth, guess, "k")
    evaluation.require_aligned(truth, truth, "k")


def test_roc_auc_with_ties(spark):
    random.seed(3)
    data = [(random.randint(0, 1), random.choice([0.1, 0.2, 0.2, 0.5, 0.9, random.random()])) for _ in range(500)]
    frame = spark.createDataFrame(data, "label int, score double")
    spam = [s for l, s in data if l == 1]
    ham = [s for l, s in data if l == 0]
    won = sum((s > h) + 0.5 * (s == h) for s in spam for h in ham)
    row = evaluation.roc_auc(frame).first()
    assert row["roc_auc"] == pytest.approx(won / len(spam) / len(ham), abs=1e-6)
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert row["roc_auc"] == pytest.approx(judge.evaluate(frame), abs=1e-6)


def test_roc_auc_without_a_class(spark):
    frame = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert evaluation.roc_auc(frame).first()["roc_auc"] is None


def test_numeric_helpers(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "n double, d double")
    out = frame.select(
        numeric.safe_divide(F.col("n"), F.col("d")).alias("q"),
        numeric.sigmoid(F.col("d")).alias("s"),
        numeric.round_half_even(F.lit(0.0078125)).alias("r"),
    ).collect()
    assert [r["q"] for r in out] == [0.0, 0.25]
    assert out[0]["s"] == 0.5 and out[0]["r"] == 0.007812
