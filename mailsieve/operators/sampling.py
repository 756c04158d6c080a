"""Exact, seeded, partition-independent sampling and splitting.

Rows are ordered by a seeded hash of their key and the lowest ones are taken. The
cut is found without ranking the table: rows are counted per hash prefix, the
prefix that holds the cut is picked from those counts, the rows of that prefix
are counted again by a longer one, and only the rows of the last prefix are ranked:
one in four thousand million. The full rows are then compared with one boundary per
class, in the scan itself: they are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.schema import ROW_KEY

#: Growing lengths of hash prefixes, in hexadecimal digits: at most 65,536 counts per
#: class leave each task.
PREFIX_DIGITS = (4, 8)

Quota = Callable[[DataFrame], DataFrame]


def seeded_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _all_rows() -> Window:
    # Only ever used on one row per class.
    return Window.partitionBy(F.lit(1))


def smallest_class(sizes: DataFrame) -> DataFrame:
    """Every class gives as many rows as the smallest present class has."""
    return sizes.withColumn("quota", F.min("size").over(_all_rows()))


def class_sizes(frame: DataFrame, class_col: str = "label") -> DataFrame:
    """Rows per class, with the smallest class size and the number of classes."""
    sizes = frame.groupBy(class_col).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumns(
        {
            "smallest": sizes.agg(F.min("size")).scalar(),
            "n_classes": sizes.agg(F.count(F.lit(1))).scalar(),
        }
    )


def capped_classes(sample_size: int) -> Quota:
    """An equal share of ``sample_size`` per class, if there are more rows than that."""

    def quota(sizes: DataFrame) -> DataFrame:
        total = F.sum("size").over(_all_rows())
        n_classes = F.count(F.lit(1)).over(_all_rows())
        share = F.greatest(F.lit(1), F.floor(F.lit(sample_size) / n_classes))
        return sizes.withColumn(
            "quota",
            F.when(total > sample_size, F.least("size", share)).otherwise(F.col("size")),
        )

    return quota


def stratified_share(test_share: float = settings.TEST_SHARE) -> Quota:
    """The test part of each class: rounded down, the rest to the largest fractions."""

    def quota(sizes: DataFrame) -> DataFrame:
        total = F.sum("size").over(_all_rows())
        n_test = F.ceil(F.lit(float(test_share)) * total)
        # The product of two row counts does not fit a long.
        product = n_test.cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")
        remainder = product % total
        whole = ((product - remainder) / total).cast("long")
        sized = sizes.withColumns({"whole": whole, "remainder": remainder, "n_test": n_test})
        left = F.col("n_test") - F.sum("whole").over(_all_rows())
        place = F.row_number().over(
            Window.partitionBy(F.lit(1)).orderBy(F.desc("remainder"), "class")
        )
        return sized.withColumn("quota", F.col("whole") + (place <= left).cast("long"))

    return quota


def _by_class(table: DataFrame, *names: str) -> Column:
    """A table of one row per class as a single map, for use inside other queries."""
    entry = F.struct("class", F.struct(*names))
    return table.agg(F.map_from_entries(F.collect_list(entry)).alias("by_class")).scalar()


def _of_class(by_class: Column, klass: Column, name: str) -> Column:
    return F.try_element_at(by_class, klass).getField(name)


def flag_smallest(
    frame: DataFrame,
    quota: Quota,
    flag: str,
    class_col: str | None = "label",
    row_key: str = ROW_KEY,
    seed: int | str = settings.SEED,
    classes: Sequence[int] = settings.LABELS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Mark in each class the ``quota`` rows with the lowest seeded hash.

    ``classes`` is the closed list of classes: quotas and cuts are single values with
    one entry per class, computed ahead of the scan that uses them. Without ``class_col`` the whole table is
    one class. ``keys`` may hold the class and row key columns of the same rows in a
    narrower table, which is then read to find the cut.
    """
    if class_col is None:
        classes = (0,)
    klass = F.lit(0) if class_col is None else F.col(class_col).cast("int")
    keyed = (frame if keys is None else keys).select(
        klass.alias("class"),
        F.col(row_key).alias("key"),
        seeded_hash(F.col(row_key), seed).alias("hash"),
    ).filter(F.col("class").isin(*classes))
    sizes = keyed.groupBy("class").agg(F.count(F.lit(1)).alias("size"))
    need = _of_class(_by_class(quota(sizes), "quota"), F.col("class"), "quota")
    upto = Window.partitionBy("class").orderBy("prefix")
    for digits in PREFIX_DIGITS:
        counts = (
            keyed.groupBy("class", F.substring("hash", 1, digits).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("running", F.sum("n").over(upto))
        )
        cut = counts.withColumn("need", need - (F.col("running") - F.col("n"))).filter(
            (F.col("need") > 0) & (F.col("need") <= F.col("n"))
        )
        cuts = _by_class(cut, "prefix", "need")
        need = _of_class(cuts, F.col("class"), "need")
        # Not an equality: on a joined input that would become a key of its join.
        keyed = keyed.filter(F.col("hash").startswith(_of_class(cuts, F.col("class"), "prefix")))

    order = Window.partitionBy("class").orderBy("hash", "key")
    last = keyed.withColumn("place", F.row_number().over(order)).filter(F.col("place") == need)
    lasts = _by_class(last, "hash", "key")

    # One comparison, by hash and then by key, with one mention of the subquery.
    place = F.struct(
        seeded_hash(F.col(row_key), seed).alias("hash"), F.col(row_key).alias("key")
    )
    taken = place <= F.try_element_at(lasts, klass)
    return frame.withColumn(flag, F.coalesce(taken, F.lit(False)))


def take_smallest(frame: DataFrame, quota: Quota, **options) -> DataFrame:
    return flag_smallest(frame, quota, "_taken", **options).filter("_taken").drop("_taken")


def balance_classes(frame: DataFrame, **options) -> DataFrame:
    """The same number of rows from every class: as many as the smallest has."""
    return take_smallest(frame, smallest_class, **options)


def capped_sample(frame: DataFrame, sample_size: int, **options) -> DataFrame:
    return take_smallest(frame, capped_classes(sample_size), **options)


def stratified_split(
    frame: DataFrame, test_share: float = settings.TEST_SHARE, flag: str = "is_test", **options
) -> DataFrame:
    """Add a test flag that keeps the class shares."""
    return flag_smallest(frame, stratified_share(test_share), flag, **options)


def random_split(
    frame: DataFrame, test_share: float = settings.TEST_SHARE, flag: str = "is_test", **options
) -> DataFrame:
    """Add a test flag without regard to classes."""
    return flag_smallest(frame, stratified_share(test_share), flag, class_col=None, **options)


def shuffled(frame: DataFrame, row_key: str = ROW_KEY, seed: int | str = settings.SEED) -> DataFrame:
    """Rows in seeded random order: a range-partitioned sort, for use before a write."""
    return frame.orderBy(seeded_hash(F.col(row_key), seed), row_key)
