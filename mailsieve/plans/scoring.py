"""Scoring of new messages with a stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.functions.labels import display_name
from mailsieve.functions.numeric import round_half_even, sigmoid
from mailsieve.functions.text import with_clean_text
from mailsieve.sources.readers import read_text_files, texts_to_frame

#: Sample messages for a quick look at a model; no result depends on them.
DEMO_TEXTS = [
    "The minutes of Tuesday's call are in the shared folder, comments by Friday please.",
    "YOU HAVE BEEN SELECTED!!! Reply with your card number and $500 are yours.",
    "Lunch at noon? The new place on the corner has a quiet table for four.",
    "Final notice: your parcel waits at www.parcel-fee.example until the fee is paid.",
    "The nightly build failed on two machines, logs are attached.",
]


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def spam_score(model: PipelineModel) -> Column:
    """Probability of spam; the squashed margin where a model has no probability."""
    last = model.stages[-1]
    if last.hasParam("probabilityCol"):
        return vector_to_array(F.col(last.getOrDefault("probabilityCol")))[1]
    if last.hasParam("rawPredictionCol"):
        return sigmoid(vector_to_array(F.col(last.getOrDefault("rawPredictionCol")))[1])
    return F.col(last.getOrDefault("predictionCol")).cast("double")


def score_texts(
    model: PipelineModel, frame: DataFrame, text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Clean and score every row. Works the same on a table and on a stream."""
    # The model's stages read a column called "text".
    texts = frame.select(*keep, F.col(text_col).alias("text"))
    scored = model.transform(with_clean_text(texts, "text", "text"))
    label = F.col(model.stages[-1].getOrDefault("predictionCol")).cast("int")
    return scored.select(
        *keep,
        label.alias("label"),
        display_name(label).alias("prediction"),
        round_half_even(spam_score(model)).alias("spam_score"),
        F.col("text").alias("cleaned_text"),
    )


def score_files(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    return score_texts(model, read_text_files(spark, path), keep=["file_path"])


def score_demo(
    spark: SparkSession, model: PipelineModel, texts: Sequence[str] = tuple(DEMO_TEXTS)
) -> DataFrame:
    frame = texts_to_frame(spark, texts)
    return score_texts(model, frame, "input_text", keep=["demo_id", "input_text"])
