"""CSV whose quoted fields hold line ends, read by many tasks.

A line end inside quotes ends no record, so a task that starts in the middle of a file cannot tell
records apart by itself. Doubled quotes keep the count of quotes even, hence:

1. lines are read in splits, as Spark cuts the files; quotes are counted per split (one row each);
2. a prefix scan over the splits of a file tells which of them begin inside quotes;
3. each task then knows for all of its lines whether they begin a record. It emits records, the
   lines before its first one, and the record that is still open at its end;
4. records that go on in later splits are put together from these pieces, two at most per split.

Records are then parsed by Spark's own CSV expression. Line ends inside quotes stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.session import importable_by_workers, written

OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
_RECORD, _HEAD, _TAIL = range(3)
_SPLIT = ["file", "start", "length"]
_KINDS = "file string, start bigint, length bigint, kind int, place bigint, header boolean, record string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    value = F.col("value")
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("line"),
        ((F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))) % 2).alias("odd"),
        value,
    )


def _open_splits(lines: DataFrame) -> DataFrame:
    """Each split with whether it begins inside quotes: the parity of all quotes before it."""
    parity = lines.groupBy(*_SPLIT).agg((F.sum("odd") % 2).alias("odd"))
    ahead = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select(*_SPLIT, (F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2 == 1).alias("open"))


class _Split:
    """Records of one split, line by line."""

    def __init__(self, key: tuple, inside: bool):
        self.key, self.inside = key, inside
        self.header = key[1] == 0
        self.place = 0
        # Lines of the record at hand; before the first record they are the end of an earlier one.
        self.held: list[str] = []
        self.kind = _HEAD if inside else _RECORD

    def take(self, values: list[str], odd: np.ndarray) -> Iterator[tuple]:
        inside = (np.cumsum(odd) - odd + self.inside) % 2 == 1
        begins = [*np.flatnonzero(~inside).tolist(), len(values)]
        if begins[0] > 0:
            self.held += values[: begins[0]]
        for a, b in zip(begins, begins[1:], strict=False):
            yield from self._close()
            self.held = values[a:b]
        self.inside = bool((self.inside + int(odd.sum())) % 2)

    def _close(self, kind: int | None = None) -> Iterator[tuple]:
        if self.held:
            kind = self.kind if kind is None else kind
            header = self.header and kind != _HEAD
            yield (*self.key, kind, self.place, header, "\n".join(self.held))
            if kind != _HEAD:
                self.header = False
                self.place += 1 - header
        self.held, self.kind = [], _RECORD

    def end(self) -> Iterator[tuple]:
        """What is left is whole, unless quotes are still open."""
        yield from self._close(_TAIL if self.inside and self.kind == _RECORD else None)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in the order of their split to records and pieces."""
    split: _Split | None = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string())
        names = [*_SPLIT, "kind", "place", "header", "record"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        starts = batch.column(1).to_numpy(zero_copy_only=False)
        files = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        odd = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
        values = batch.column(5).to_pylist()
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (files[1:] != files[:-1])) + 1
        rows: list[tuple] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
            if a == b:
                continue
            key = tuple(batch.column(i)[a].as_py() for i in range(3))
            if split is None or split.key != key:
                if split is not None:
                    rows += split.end()
                split = _Split(key, batch.column(3)[a].as_py())
            rows += split.take(values[a:b], odd[a:b])
        yield batch_of(rows)
    if split is not None:
        yield batch_of(list(split.end()))


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records from the pieces of several splits: the one that begins it, and all up to its end."""
    splits = pieces.groupBy("file", "start").agg(F.max(F.col("kind") == _TAIL).alias("begins"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("begins"), F.col("start")), ignorenulls=True).over(before)
    owned = pieces.join(splits.select("file", "start", owner.alias("earlier")), ["file", "start"]).withColumn(
        "owner", F.when(F.col("kind") == _TAIL, F.col("start")).otherwise(F.col("earlier"))
    )
    first = F.min(F.struct("start", F.struct("length", "place", "header")))["col2"]
    joined = F.array_sort(F.collect_list(F.struct("start", "record")))
    return (
        owned.groupBy("file", "owner")
        .agg(first.alias("first"), joined.alias("parts"))
        .select(
            "file", F.col("owner").alias("start"), "first.place", "first.header",
            F.array_join("parts.record", "\n").alias("record"),
        )
    )


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, start, place (order in a file: by both) and record of each CSV record, headers left out.

    Splits may be cut differently when cores come or go between the two scans: that is an error,
    and reading once more mends it.
    """
    importable_by_workers(spark)
    lines = _lines(spark, path)
    states = written(_open_splits(lines), "csv-splits")
    known = lines.join(F.broadcast(states), _SPLIT, "left").select(  # one row per split
        *_SPLIT,
        F.coalesce("open", F.raise_error(F.lit("the input was cut anew while it was read; read it again")).cast("boolean")).alias("open"),
        "odd", "value", "line",
    )
    ordered = known.sortWithinPartitions("file", "start", "line").drop("line")
    found = written(ordered.mapInArrow(_records, _KINDS), "csv-records")
    whole = found.where(F.col("kind") == _RECORD).select("file", "start", "place", "header", "record")
    every = whole.unionByName(_stitched(found.where(F.col("kind") != _RECORD)))
    ended = F.regexp_replace("record", "\r$", "")
    return every.where("not header").withColumn("record", ended).where("record != ''").drop("header")


def header_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    return spark.read.options(header=True, **OPTIONS).csv(path).columns


def read_split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, row_key: str | None = None
) -> DataFrame:
    """All records as columns. With ``row_key`` rows are numbered from 0 in the order of the files'
    names and of their records. The header must hold the names of ``schema``, if one is given."""
    names = header_of(spark, path)
    if schema is None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    elif [f.name.lower() for f in schema.fields] != [name.lower() for name in names]:
        raise ValueError(f"the header is {names}, expected {schema.fieldNames()}")
    records = read_records(spark, path)
    parsed = F.from_csv("record", schema.toDDL(), OPTIONS)
    if row_key is None:
        return records.select(parsed.alias("row")).select("row.*")
    # One row per split of an input file.
    sizes = records.groupBy("file", "start").agg(F.max("place").alias("last"))
    ahead = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "start", F.coalesce(F.sum(F.col("last") + 1).over(ahead), F.lit(0)).alias("before"))
    numbered = records.join(F.broadcast(offsets), ["file", "start"]).select((F.col("before") + F.col("place")).alias(row_key), parsed.alias("row"))
    return numbered.select("row.*", row_key)
