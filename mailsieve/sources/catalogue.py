"""The mail archives whose folder decides the label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Archive folder and label of its messages.
ARCHIVES = [
    ("easy_ham", 0),
    ("hard_ham", 0),
    ("spam", 1),
    ("easy_ham_2", 0),
    ("spam_2", 1),
]


def archive_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ARCHIVES, "archive string, label int")
