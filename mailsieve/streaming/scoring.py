"""Scoring of messages as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mailsieve.functions.text import strip
from mailsieve.plans.scoring import score_texts


def read_message_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    **options,
) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).format(file_format).load(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """Stream a parquet table of that name, be it one file or a folder of part files.

    A stream reads folders: a single file is found by its name in the folder above.
    """
    path = f"{folder}/{name}"
    table = spark.read.parquet(path)
    if any(file.rstrip("/").endswith(f"/{name}") for file in table.inputFiles()):
        return read_message_stream(spark, folder, table.schema, pathGlobFilter=name, **options)
    return read_message_stream(spark, path, table.schema, **options)


def score_stream(
    model: PipelineModel, messages: DataFrame, text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Score every message that is not blank. Stateless: no watermark is needed."""
    present = messages.filter(strip(F.col(text_col)) != "")
    return score_texts(model, present, text_col, keep)


def start_scoring(
    scored: DataFrame,
    output_path: str,
    checkpoint_path: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Append scores to a parquet table; progress survives restarts."""
    writer = (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
