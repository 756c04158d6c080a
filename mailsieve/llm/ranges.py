"""Running sums inside groups of any size, without one task that sees a whole group.

Rows are dealt to range partitions by group and order, so a large group lies in several
neighbouring ones. Each partition adds up on its own; only groups at the border of a partition go
on in the next one, so the totals to be carried over are two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve.llm.common import map_arrow, written


def _local_sums(group_at: int, value_at: int, names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            groups = batch.column(group_at).to_numpy(zero_copy_only=False)
            values = batch.column(value_at).to_numpy(zero_copy_only=False)
            n = len(groups)
            if not n:
                continue
            sums = np.cumsum(values) - values
            heads = np.concatenate(([0], np.flatnonzero(groups[1:] != groups[:-1]) + 1))
            base = -sums[heads]
            if last is not None and groups[0] == last:
                base[0] += carried
            before = sums + np.repeat(base, np.diff(np.append(heads, n)))
            last, carried = groups[-1], int(before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(before.astype(np.int64))],
                [*names, "part", "local"],
            )

    return work


def running_before(
    frame: DataFrame, group: str, order: Sequence[str | Column], value: str, keep: Sequence[str], name: str
) -> DataFrame:
    """Columns ``keep`` and ``name``: the sum of ``value`` over the rows before it in its group.

    ``group`` is a long without nulls and ``value`` a long; rows of equal order come in any order.
    """
    columns = list(dict.fromkeys([group, value, *keep]))
    # Equal rows may be very many: their own number lets them lie in several partitions.
    numbered = frame.withColumn("_row", F.monotonically_increasing_id())
    sort = [F.col(group), *order, F.col("_row")]
    dealt = numbered.repartitionByRange(*sort).sortWithinPartitions(*sort).select(*columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    stored = written(
        map_arrow(dealt, _local_sums(0, columns.index(value), columns), f"{kinds}, part int, local bigint"), "running"
    )
    borders = (
        stored.groupBy("part")
        .agg(F.array(F.min(group), F.max(group)).alias("both"))
        .select(F.explode("both").alias(group))
        .distinct()
    )
    so_far = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        stored.join(F.broadcast(borders), group)  # two rows per partition
        .groupBy(group, "part")
        .agg(F.sum(value).alias("total"))
        .withColumn("carried", F.sum("total").over(so_far))
        .where("carried is not null")
        .select(group, "part", "carried")
    )
    return stored.join(F.broadcast(carried), [group, "part"], "left").select(
        *keep, (F.col("local") + F.coalesce("carried", F.lit(0))).alias(name)
    )
