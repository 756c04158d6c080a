"""Linear models as tables: one row per term, scored by a join.

A model of any vocabulary can be scored this way: neither the driver nor a task holds it. The
most frequent terms, a fixed number of them, are joined where the texts lie; they are most of all
occurrences and the only ones that could crowd a shuffle. The rest is joined by term. Sums are
combined per text before they are brought together. Terms that the model cannot hold, told by a
bitmap of hashes, are left out before a text's terms are counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions.labels import display_name
from mailsieve.functions.numeric import round_half_even, sigmoid
from mailsieve.functions.text import with_clean_text
from mailsieve.operators.terms import counted_terms, only_terms_of, with_terms
from mailsieve.session import written
from mailsieve.sources.sinks import write_json, write_table

#: Terms that are joined by broadcast, the most frequent ones: some 100 bytes each.
FREQUENT = 10_000


@dataclass(frozen=True)
class TableModel:
    """``terms`` holds term, idf, weight and df (to tell frequent terms); unit-length texts."""

    terms: DataFrame
    intercept: float
    ngram_range: tuple[int, int] = settings.NGRAM_RANGE
    stopwords: tuple[str, ...] = ()

    def save(self, path: str) -> str:
        write_table(self.terms, f"{path}/terms")
        row = [(self.intercept, list(self.ngram_range), list(self.stopwords))]
        spark = self.terms.sparkSession
        write_json(spark.createDataFrame(row, "intercept double, ngram_range array<int>, stopwords array<string>"), f"{path}/model")
        return path


def load_table_model(spark: SparkSession, path: str) -> TableModel:
    head = spark.read.schema("intercept double, ngram_range array<int>, stopwords array<string>").json(f"{path}/model").first()
    return TableModel(spark.read.parquet(f"{path}/terms"), head["intercept"], tuple(head["ngram_range"]), tuple(head["stopwords"]))


def table_of(model: PipelineModel, ngram_range: Sequence[int], stopwords: Iterable[str]) -> TableModel:
    """A trained linear pipeline without hand-made features as a table."""
    (words,) = [s for s in model.stages if isinstance(s, CountVectorizerModel)]
    (scaled,) = [s for s in model.stages if isinstance(s, ElementwiseProduct)]
    last = model.stages[-1]
    if last.numFeatures != len(words.vocabulary):
        raise ValueError("only models on terms alone can be stored as a table")
    rows = zip(words.vocabulary, scaled.getScalingVec().toArray().tolist(), last.coefficients.toArray().tolist(), strict=True)
    spark = SparkSession.getActiveSession()
    terms = spark.createDataFrame(list(rows), "term string, idf double, weight double")
    # The inverse document frequency falls with the frequency.
    return TableModel(terms.withColumn("df", -F.col("idf")), float(last.intercept), tuple(ngram_range), tuple(stopwords))


def margins(model: TableModel, frame: DataFrame, row_key: str, text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """row_key and margin of each row of ``frame``; ``row_key`` must be unique."""
    termed = with_terms(frame.select(row_key, F.col(text_col).alias("text")), "text", model.ngram_range, model.stopwords)
    texts = written(counted_terms(only_terms_of(termed, model.terms)).select(row_key, "counted"), "counted-texts")
    entries = texts.select(row_key, F.inline("counted"))
    often = model.terms.orderBy(F.desc("df"), "term").limit(frequent).select("term", F.lit(True).alias("often"))
    marked = written(model.terms.join(F.broadcast(often), "term", "left"), "model-terms")
    columns = ["term", "idf", "weight"]
    near = F.broadcast(marked.where("often").select(*columns))
    found = entries.join(near, "term").unionByName(
        entries.join(F.broadcast(marked.where("often").select("term")), "term", "left_anti").join(
            marked.where("often is null").select(*columns), "term"
        )
    )
    part = F.col("tf") * F.col("idf")
    sums = found.groupBy(row_key).agg(
        F.sum(part * F.col("weight")).alias("weighed"), F.sum(part * part).alias("square")
    )
    # A text without a known term has no direction: its margin is the intercept.
    return texts.select(row_key).join(sums, row_key, "left").select(
        row_key, (F.coalesce(F.col("weighed") / F.sqrt("square"), F.lit(0.0)) + F.lit(model.intercept)).alias("margin")
    )


def score_table(
    model: TableModel, frame: DataFrame, row_key: str, text_col: str = "text", clean: bool = True
) -> DataFrame:
    """row_key, label, prediction and spam_score (the squashed margin) of each row."""
    texts = frame.select(row_key, F.col(text_col).alias("text"))
    scored = margins(model, with_clean_text(texts, "text", "text") if clean else texts, row_key)
    label = (F.col("margin") > 0).cast("int")
    return scored.select(
        row_key,
        label.alias("label"),
        display_name(label).alias("prediction"),
        round_half_even(sigmoid(F.col("margin"))).alias("spam_score"),
    )
