"""What the text operators share: inputs, ASCII lower case, held-out rows, worker imports."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.session import written

__all__ = ["ascii_lower", "free_names", "held_out", "map_arrow", "table", "text_slices", "worker_path", "written"]

_SLICE_BYTES = 1 << 21

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text.

    On texts of ASCII only, where every character is one byte, ``lower`` does the same
    and is faster.
    """
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id as text leaves no rest by 5.

    A null id has no crc and counts as not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def worker_path(spark: SparkSession) -> None:
    """Let workers import this package, from wherever the session was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if _ROOT not in paths:
        paths.insert(0, _ROOT)
    env["PYTHONPATH"] = os.pathsep.join(paths)


def map_arrow(
    frame: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    slice_bytes: int = _SLICE_BYTES,
) -> DataFrame:
    """``mapInArrow`` with a package that workers can import.

    ``work`` sees batches of about ``slice_bytes`` of text, whatever Spark's batches hold: the
    memory of a worker does not follow the length of the texts, only that of the longest.
    """
    worker_path(frame.sparkSession)

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(part for batch in batches for part in _byte_slices(batch, slice_bytes))

    return frame.mapInArrow(sliced, schema)


def _byte_slices(batch: pa.RecordBatch, slice_bytes: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows whose texts and binaries sum up to about ``slice_bytes``."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + slice_bytes, side="right")))
        yield batch.slice(start, end - start)
        start = end


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted`` with underscores added where ``taken`` holds the name, whatever its case."""
    used = {name.lower() for name in taken}
    names = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names


def text_slices(batch: pa.RecordBatch, column: int, slice_bytes: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows whose texts sum up to about ``slice_bytes``.

    Keeps the memory of a worker independent of the batch size; a single longer text
    still makes a run of its own.
    """
    texts = batch.column(column)
    start, size = 0, 0
    for i in range(batch.num_rows):
        length = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
        if size and size + length > slice_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)
