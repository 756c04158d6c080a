"""Readers for message tables, raw mail folders and single-message text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.functions.labels import label_name, merge_phishing, numeric_label
from mailsieve.functions.text import as_text
from mailsieve.operators.normalise import normalise_messages
from mailsieve.schema import ROW_KEY, require_columns
from mailsieve.session import written
from mailsieve.settings import LABELS
from mailsieve.sources.catalogue import archive_catalogue
from mailsieve.sources.split_csv import header_of, read_split_csv

_BLANK_LINE = r"\r?\n\r?\n"
_SUBJECT = r"(?imd)^Subject:[ \t]*([^\n]*(?:\n[ \t]+[^\n]*)*)"
_FOLD = r"\r?\n[ \t]+"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header and quoted, possibly multi-line, fields.

    Without a schema all columns are strings, named by the header. Large files are split
    over tasks. Fields without line ends need no search for the quotes that hold them:
    ``multi_line=False`` leaves it out.
    """
    if multi_line:
        return read_split_csv(spark, path, schema)
    reader = spark.read.options(header=True, quote='"', escape='"')
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def ingest_csv(
    spark: SparkSession,
    path: str,
    row_key: str = ROW_KEY,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read a CSV once into a stored table with a row key that follows file order.

    Within a file the ids grow with the position. Storing them fixes them for all later
    reads. Keys of several files read one by one overlap; ``load_sources`` tells them apart.
    """
    if multi_line:
        keyed = row_key in header_of(spark, path)
        return written(read_split_csv(spark, path, schema, None if keyed else row_key), "csv-ingest")
    table = read_csv(spark, path, schema, multi_line)
    if row_key not in table.columns:
        table = table.withColumn(row_key, F.monotonically_increasing_id())
    return written(table, "csv-ingest")


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_three_class(spark: SparkSession, path: str, source: str, row_key: str) -> DataFrame:
    """Labelled parquet with ham, phishing and spam, as two-class messages."""
    table = read_parquet(spark, path)
    require_columns(table, ["label", "text", row_key])
    merged = table.withColumns(
        {"label": merge_phishing(F.col("label")), "source": F.lit(source)}
    )
    return normalise_messages(merged, row_key)


def read_first_existing(
    spark: SparkSession, paths: Sequence[str], file_format: str = "parquet"
) -> DataFrame:
    """The first of the paths that exists."""
    for path in paths:
        try:
            if file_format == "csv":
                return read_csv(spark, path)
            return spark.read.format(file_format).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no input found at: {', '.join(paths)}")


def valid_utf8(content: Column) -> Column:
    """Bytes as text; invalid sequences become the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def mail_subject(message: Column) -> Column:
    headers = F.split(message, _BLANK_LINE, 2)[0]
    folded = F.regexp_extract(headers, _SUBJECT, 1)
    return F.btrim(F.regexp_replace(folded, _FOLD, " "), F.lit(" \t\r"))


def mail_body(message: Column) -> Column:
    return as_text(F.get(F.split(message, _BLANK_LINE, 2), 1))


def read_mail_folders(spark: SparkSession, path: str, source: str = "mail_archive") -> DataFrame:
    """One message per file; the folder name decides the label.

    Files in folders that are not in the catalogue keep a null label, so that the
    audit lists them. The file name is unique within its folder.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ).select(F.split("path", "/").alias("parts"), valid_utf8(F.col("content")).alias("message"))
    messages = files.select(
        F.element_at("parts", -2).alias("archive"),
        F.element_at("parts", -1).alias("file_name"),
        "message",
    )
    catalogue = F.broadcast(archive_catalogue(spark))  # five fixed rows
    return messages.join(catalogue, "archive", "left").select(
        F.concat_ws("/", "archive", "file_name").alias("file_key"),
        F.lit(source).alias("source"),
        "file_name",
        "label",
        label_name(F.col("label")).alias("label_name"),
        mail_subject(F.col("message")).alias("subject"),
        mail_body(F.col("message")).alias("text"),
    )


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Each text file is one message."""
    files = spark.read.text(path, wholetext=True)
    text = F.regexp_replace(F.make_valid_utf8("value"), "\r\n?", "\n")
    return files.select(F.col("_metadata.file_path").alias("file_path"), text.alias("text"))


def texts_to_frame(spark: SparkSession, texts: Sequence[str]) -> DataFrame:
    """A few texts given in code, numbered from 1."""
    rows = list(enumerate(texts, start=1))
    return spark.createDataFrame(rows, "demo_id int, input_text string")


def training_rows(frame: DataFrame) -> DataFrame:
    """Rows with a known label; null texts are empty."""
    require_columns(frame, ["label", "text"])
    label = F.col("label")
    if not isinstance(frame.schema["label"].dataType, T.NumericType):
        label = numeric_label(label)
    return frame.filter(label.isin(*LABELS)).withColumns(
        {"label": label.cast("int"), "text": as_text(F.col("text"))}
    )
