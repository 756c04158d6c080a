"""Training and comparison of the three classifiers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel, NaiveBayes
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions.text import with_clean_text
from mailsieve.operators.evaluation import compare_models, long_predictions, model_metrics
from mailsieve.operators.linear import Problem, fit_linear, vector_rows
from mailsieve.operators.sampling import capped_sample, stratified_split
from mailsieve.operators.terms import TfidfModel, combine_features, fit_tfidf, manual_feature_stage
from mailsieve.schema import ROW_KEY
from mailsieve.session import side_by_side, written
from mailsieve.sources.readers import training_rows
from mailsieve.sources.sinks import write_csv, write_json

# Model names.
MODEL_NAMES = ["naive_bayes", "logistic_regression", "linear_svm"]


# Which loss each of the iterative models minimises.
LOSSES = {"logistic_regression": "logistic", "linear_svm": "squared_hinge"}


def naive_bayes() -> NaiveBayes:
    return NaiveBayes(
        smoothing=settings.NAIVE_BAYES_ALPHA,
        featuresCol="features",
        labelCol="label",
        predictionCol="naive_bayes",
        rawPredictionCol="naive_bayes_raw",
        probabilityCol="naive_bayes_probability",
    )


def linear_model(spark: SparkSession, name: str, weights: np.ndarray, intercept: float) -> Model:
    """Weights as one of Spark's models, which scores in the engine and can be stored."""
    kind = {"logistic_regression": LogisticRegressionModel, "linear_svm": LinearSVCModel}[name]
    made = getattr(spark._jvm.org.apache.spark.ml.classification, kind.__name__)(
        f"{name}_{uuid.uuid4().hex[:12]}", _py2java(spark.sparkContext, Vectors.dense(weights)), float(intercept)
    )
    model = kind(made)._set(featuresCol="features", predictionCol=name, rawPredictionCol=f"{name}_raw")
    return model._set(probabilityCol=f"{name}_probability") if name == "logistic_regression" else model


@dataclass(frozen=True)
class Fit:
    """A fitted classifier: solver steps, passes over the vectors, length of the last gradient."""

    model: Model
    steps: int = 0
    passes: int = 1
    gradient: float = 0.0


def fit_classifiers(names: Sequence[str], train: DataFrame, n_features: int) -> dict[str, Fit]:
    """Fit classifiers on stored vectors. The iterative ones share their passes over them.

    A solver that was cut off by its step limit is an error. Bound the cost of a pass with
    ``sample_size``: it bounds the labelled rows.
    """
    unknown = set(names) - set(MODEL_NAMES)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    spark = train.sparkSession

    def closed_form() -> dict[str, Fit]:
        return {"naive_bayes": Fit(naive_bayes().fit(train))} if "naive_bayes" in names else {}

    def iterative() -> dict[str, Fit]:
        wanted = [name for name in names if name in LOSSES]
        if not wanted:
            return {}
        solved = fit_linear(vector_rows(train), [Problem(0, LOSSES[name]) for name in wanted], n_features)
        return {
            name: Fit(linear_model(spark, name, s.weights, s.intercept), s.steps, s.passes, s.gradient)
            for name in wanted
            for s in [solved[Problem(0, LOSSES[name])]]
        }

    found = {}
    for part in side_by_side(spark, lambda work: work(), [closed_form, iterative]):
        found |= part
    return {name: found[name] for name in names}


@dataclass(frozen=True)
class Training:
    best_name: str
    models: dict[str, PipelineModel]
    metrics: DataFrame
    predictions: DataFrame
    train_rows: int
    test_rows: int
    fits: dict[str, Fit]

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best_name]


class TextFeatures(PipelineModel):
    """The stages of the text features. Read back from a store, they are a pipeline like any other.

    Its own ``transform`` makes the same TF-IDF vectors in Arrow batches.
    """

    def __init__(self, tfidf: TfidfModel, text_col: str, tfidf_col: str, others: Sequence[Transformer] = ()):
        super().__init__([*tfidf.stages(text_col, tfidf_col), *others])
        self._vectors = lambda frame: tfidf.transform(frame, text_col, tfidf_col)
        self._others = PipelineModel(list(others))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._others.transform(self._vectors(dataset))


def feature_model(
    train: DataFrame,
    text_col: str,
    max_features: int = settings.MAX_FEATURES,
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    with_manual: bool = False,
) -> PipelineModel:
    """Fit the text features: TF-IDF, optionally with the hand-made ones beside it."""
    tfidf = fit_tfidf(train, text_col, max_features, ngram_range)
    if not with_manual:
        return TextFeatures(tfidf, text_col, "features")
    return TextFeatures(tfidf, text_col, "tfidf", [manual_feature_stage(text_col), combine_features()])


def require_two_classes(frame: DataFrame) -> dict[int, int]:
    rows = frame.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()  # two at most
    sizes = {row["label"]: row["n"] for row in rows}
    if len(sizes) < 2:
        raise ValueError("the dataset needs both labels: 0 = not spam, 1 = spam")
    return sizes


def train_models(
    dataset: DataFrame,
    sample_size: int | None = None,
    text_col: str = "text",
    clean: bool = True,
    with_manual: bool = False,
    names: Sequence[str] = MODEL_NAMES,
    max_features: int = settings.MAX_FEATURES,
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    test_share: float = settings.TEST_SHARE,
    seed: int = settings.SEED,
    row_key: str = ROW_KEY,
) -> Training:
    """Split, fit the features once, fit each classifier on them, compare on the test part.

    ``clean`` trains on the cleaned text, which is also what scoring uses; without
    it the raw text is used.
    """
    rows = training_rows(dataset.withColumn("text", F.col(text_col))).select(
        row_key, "label", "text"
    )
    if clean:
        rows = with_clean_text(rows, "text", "text")
    sizes = require_two_classes(rows)
    if sample_size and sum(sizes.values()) > sample_size:
        rows = capped_sample(rows, sample_size, row_key=row_key, seed=seed)
    split = written(
        stratified_split(rows, test_share, row_key=row_key, seed=seed), "training-split"
    )
    features = feature_model(
        split.filter(~F.col("is_test")), "text", max_features, ngram_range, with_manual
    )
    # Every solver iterates over the vectors: store them once.
    vectors = written(
        features.transform(split).select(row_key, "label", "is_test", "features"),
        "training-vectors",
    )
    train = vectors.filter(~F.col("is_test"))
    test = vectors.filter("is_test")
    parts = {row["is_test"]: row["count"] for row in vectors.groupBy("is_test").count().collect()}
    train_rows, test_rows = parts.get(False, 0), parts.get(True, 0)

    n_features = vectors.select("features").first()["features"].size
    fits = fit_classifiers(names, train, n_features)
    models = {}
    scored = test
    for name, fit in fits.items():
        models[name] = PipelineModel([*features.stages, fit.model])
        scored = fit.model.transform(scored)
    predictions = written(
        scored.select(row_key, "label", *(F.col(name).cast("int") for name in names)),
        "test-predictions",
    )
    metrics = compare_models(model_metrics(long_predictions(predictions, "label", names)))
    best = metrics.first()["model"]
    return Training(best, models, metrics, predictions, train_rows, test_rows, fits)


def save_training(result: Training, output_folder: str) -> str:
    """Store every model, the best one once more, and the reports."""
    for name, model in result.models.items():
        model.write().overwrite().save(f"{output_folder}/models/{name}")
    best_path = f"{output_folder}/models/spam_classifier"
    result.best_model.write().overwrite().save(best_path)
    metrics_path = write_csv(result.metrics, f"{output_folder}/model_metrics", single_file=True)
    predictions_path = write_csv(
        result.predictions.select("label", *result.models), f"{output_folder}/model_predictions"
    )
    spark = result.metrics.sparkSession
    report = spark.createDataFrame(
        [
            (
                result.best_name,
                result.train_rows,
                result.test_rows,
                metrics_path,
                predictions_path,
                {name: fit.steps for name, fit in result.fits.items()},
                {name: fit.passes for name, fit in result.fits.items()},
                {name: fit.gradient for name, fit in result.fits.items()},
            )
        ],
        "best_model string, train_rows long, test_rows long, "
        "metrics_path string, predictions_path string, "
        "steps map<string,long>, passes map<string,long>, gradient map<string,double>",
    )
    write_json(report, f"{output_folder}/train_report")
    return best_path
