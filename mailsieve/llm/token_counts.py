"""Token counts per document from flat token files, by scanning for the separator.

``write_flat`` writes the ids of documents end to end as unsigned 16-bit integers, each
document followed by a separator id that no document holds: nothing in the files says
where a document starts. It is one pass from texts to files, without a shuffle. The same
tasks write which document stands at which place into files of their own, so that names
belong to the files whatever a later scan of the documents looks like.

``count_flat`` reads such files in blocks of ``BLOCK`` bytes. Each block is searched for
separators at once, as an array. A document may begin in one block and end in a later
one, so blocks are stitched by a prefix scan over the blocks of their file: the number of
separators before a block numbers its documents, and the last separator before it is
where its first document starts. A block is one row of a few numbers there, so a file of
any size that a file reader can hold makes a short scan.

Defined results: an empty document counts 0; ids after the last separator of a file are a
document that is not ended (``ended`` is false); empty files have none; a file that is
not a whole number of ids raises an error. For the texts behind the files a null text
counts as the empty one, null ids pass through and equal rows count one by one.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailsieve.llm.bpe import encode
from mailsieve.llm.common import map_arrow, written

SEPARATOR = 50256
BLOCK = 1 << 20
HOLDS, TOKENS, NAMES = "holds", "tokens", "names"


def write_flat(
    docs: DataFrame, vocabulary: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    separator: int = SEPARATOR,
) -> DataFrame:
    """Write flat token files below ``folder``; returns the names of their documents, as written:
    part (number of the file), ordinal (place in it) and doc_id (of a type with a text form).

    Rows keep the partitions and the order of ``docs``. A task writes a file of tokens and
    one of names, which are committed together.
    """
    spark = docs.sparkSession
    # The text writer puts out bytes as they are, and the separator after each row.
    ending = separator.to_bytes(2, "little").decode("latin-1")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kind = docs.schema[id_col].dataType
    # A line of its own per name; the separators between them make lines of two bytes at most.
    name = F.concat(
        F.lit("\n#"), F.col("place").cast("string"), F.lit(" "),
        F.coalesce(F.hex(F.col("doc_id").cast("string")), F.lit("-")), F.lit("\n"),
    )
    rows = (
        encode(docs, vocabulary, id_col, text_col, mark=False, bits=16)
        .select("doc_id", F.col("ids").cast("string").alias("ids"), place.alias("place"))
        .select(F.stack(F.lit(2), F.lit(TOKENS), F.col("ids"), F.lit(NAMES), name).alias(HOLDS, "value"))
    )
    # With a writer open for each of the two, rows are not sorted before they are written. Texts
    # go to the workers a thousand at a time, which bounds what the executor holds of them.
    with (
        _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"),
        _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"),
    ):
        (
            rows.write.partitionBy(HOLDS)
            .option("encoding", "ISO-8859-1")
            .option("lineSep", ending)
            .option("maxRecordsPerFile", 0)
            .text(folder)
        )
    lines = spark.read.option("lineSep", "\n").text(folder)
    # A table without rows leaves no files.
    lines = lines.where(F.col(HOLDS) == NAMES) if HOLDS in lines.columns else lines.where(F.lit(False))
    line = r"^#(\d+) ([0-9A-F]*|-)$"
    found = F.regexp_extract("value", line, 2)
    return lines.where(F.col("value").rlike(line)).select(
        part_number(F.col("_metadata.file_path")).alias("part"),
        F.regexp_extract("value", line, 1).cast("bigint").alias("ordinal"),
        F.when(found != "-", F.unhex(found).cast("string").cast(kind)).alias("doc_id"),
    )


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _search(separator: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for block in batch.column(2):
                data = block.as_buffer()
                if data.size % 2:
                    raise ValueError("a token file is not a whole number of ids")
                ids = np.frombuffer(data, "<u2")
                sizes.append(len(ids))
                places.append(np.flatnonzero(ids == separator))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                ],
                ["path", "block", "n_ids", "found"],
            )

    return work


def count_flat(
    spark: SparkSession, folder: str, separator: int = SEPARATOR, block: int = BLOCK
) -> DataFrame:
    """One row per document: path, ordinal (from 0 in its file), start, n_tokens, ended."""
    if block % 2:
        raise ValueError("a block must be a whole number of ids")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    if HOLDS in files.columns:
        files = files.where(F.col(HOLDS) == TOKENS)
    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(F.length("content") / block).cast("int") - 1),
        lambda i: F.substring("content", i * block + 1, F.lit(block)),
    )
    blocks = files.where("length > 0").select("path", F.posexplode(pieces).alias("block", "content"))
    # Stored: what follows reads it twice, and the files are to be read once.
    searched = written(
        map_arrow(blocks, _search(separator), "path string, block int, n_ids bigint, found array<bigint>"), "separators"
    )
    base = F.col("block").cast("bigint") * (block // 2)
    ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    stitched = (
        searched.withColumn("found", F.transform("found", lambda p: p + base))
        .withColumn("n", F.size("found").cast("bigint"))
        .withColumn("last_found", F.expr("try_element_at(found, -1)"))
        .withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .withColumn("open", F.coalesce(F.last("last_found", ignorenulls=True).over(ahead) + 1, F.lit(0)))
        .withColumn("final", F.max("block").over(whole) == F.col("block"))
    )
    starts = F.concat(
        F.array("open"), F.transform(F.slice("found", F.lit(1), F.col("n").cast("int") - 1), lambda p: p + 1)
    )
    ended = (
        stitched.where("n > 0")
        .select("path", "before", F.posexplode(F.arrays_zip(starts.alias("start"), "found")).alias("i", "doc"))
        .select(
            "path",
            (F.col("before") + F.col("i")).alias("ordinal"),
            F.col("doc.start").alias("start"),
            F.col("doc.found").alias("end"),
            F.lit(True).alias("ended"),
        )
    )
    tail = stitched.where("final").select(
        "path",
        (F.col("before") + F.col("n")).alias("ordinal"),
        F.coalesce(F.col("last_found") + 1, F.col("open")).alias("start"),
        (base + F.col("n_ids")).alias("end"),
        F.lit(False).alias("ended"),
    ).where("end > start")
    return ended.unionByName(tail).select(
        "path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended"
    )


def part_number(path):
    """The number of a file as the writer gave it."""
    return F.regexp_extract(path, r"part-(\d+)", 1).cast("int")
