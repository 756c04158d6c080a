"""Counts and distributions that describe a labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve.functions.labels import display_name
from mailsieve.functions.numeric import round_half_even, safe_divide, share_percent
from mailsieve.settings import LABELS

HISTOGRAM_BINS = 50


def table_shape(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(frame.columns)).alias("n_columns")
    )


def label_distribution(frame: DataFrame) -> DataFrame:
    """Rows, share and percent per label."""
    everything = Window.partitionBy(F.lit(1))  # one row per label
    counts = frame.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(everything)
    return counts.select(
        "label",
        display_name(F.col("label")).alias("label_name"),
        "n",
        round_half_even(safe_divide(F.col("n"), total)).alias("share"),
        share_percent(F.col("n"), total).alias("percent"),
    ).orderBy("label")


def source_label_report(frame: DataFrame) -> DataFrame:
    """Rows per source and label, with totals per source and overall."""

    def shown(name: str) -> Column:
        value = F.coalesce(F.col(name).cast("string"), F.lit("none"))
        return F.when(F.grouping(name) == 1, F.lit("all")).otherwise(value)

    return (
        frame.rollup("source", "label")
        .agg(
            shown("source").alias("source_name"),
            shown("label").alias("label_value"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(F.col("source_name").alias("source"), F.col("label_value").alias("label"), "n")
    )


def _per_column(frame: DataFrame, measure: dict[str, Column], fields: dict[str, dict]) -> DataFrame:
    """Turn one row of per-column measures into one row per column."""
    wide = frame.agg(*(value.alias(name) for name, value in measure.items()))
    cells = F.array(
        *(
            F.struct(
                F.lit(column).alias("column_name"),
                *(value.alias(name) for name, value in values.items()),
            )
            for column, values in fields.items()
        )
    )
    return wide.select(F.inline(cells))


def null_counts(frame: DataFrame) -> DataFrame:
    measure = {f"c{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(frame.columns)}
    fields = {c: {"n_null": F.col(f"c{i}")} for i, c in enumerate(frame.columns)}
    return _per_column(frame, measure, fields)


def missing_ratio(frame: DataFrame) -> DataFrame:
    """Share of nulls of the columns that have any, largest first."""
    measure = {f"c{i}": F.avg(F.col(c).isNull().cast("int")) for i, c in enumerate(frame.columns)}
    fields = {
        c: {"missing_ratio": round_half_even(F.col(f"c{i}"))} for i, c in enumerate(frame.columns)
    }
    ratios = _per_column(frame, measure, fields)
    return ratios.filter(F.col("missing_ratio") > 0).orderBy(
        F.desc("missing_ratio"), "column_name"
    )


def column_profile(frame: DataFrame) -> DataFrame:
    """Type and number of non-null values of each column."""
    measure = {f"c{i}": F.count(c) for i, c in enumerate(frame.columns)}
    fields = {
        column: {
            "position": F.lit(i),
            "data_type": F.lit(data_type),
            "n_non_null": F.col(f"c{i}"),
        }
        for i, (column, data_type) in enumerate(frame.dtypes)
    }
    return _per_column(frame, measure, fields)


def length_describe(frame: DataFrame, text_col: str = "text", by: str | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of the text length.

    Rows are counted per distinct length first, combined before the shuffle. All figures
    come from those counts, whose number is bounded by the longest text.
    """
    keys = [by] if by else []
    counts = (
        frame.select(*keys, F.length(text_col).alias("length"))
        .groupBy(*keys, "length")
        .agg(F.count("length").alias("n"))
    )
    length, n = F.col("length").cast("decimal(38,0)"), F.col("n")
    stats = counts.groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.sum(length * n).cast("double").alias("total"),
        F.sum(length * length * n).cast("double").alias("squares"),
        F.min("length").alias("min"),
        F.percentile("length", [0.25, 0.5, 0.75], F.when(n > 0, n).otherwise(F.lit(0))).alias("quartiles"),
        F.max("length").alias("max"),
    )
    count = F.nullif(F.col("count"), F.lit(0))
    deviations = F.greatest(F.lit(0.0), F.col("squares") - F.col("total") * F.col("total") / count)
    return stats.select(
        *keys,
        "count",
        round_half_even(F.col("total") / count).alias("mean"),
        round_half_even(F.sqrt(deviations / F.nullif(count - 1, F.lit(0)))).alias("std"),
        "min",
        *(F.col("quartiles")[i].alias(name) for i, name in enumerate(["p25", "p50", "p75"])),
        "max",
    )


def length_histogram(
    frame: DataFrame, text_col: str = "text", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins over each class's own range of lengths; the last is closed.

    Rows are counted per distinct length first; ranges and bins come from those
    counts. All bins are listed, empty ones with zero.
    """
    counts = (
        frame.filter(F.col("label").isin(*LABELS))
        .groupBy(F.col("label").cast("int").alias("label"), F.length(text_col).alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most two rows: one per class.
    ranges = counts.groupBy("label").agg(F.min("length").alias("low"), F.max("length").alias("high"))
    flat = F.col("low") == F.col("high")
    start = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low").cast("double"))
    width = F.when(flat, F.lit(1.0)).otherwise((F.col("high") - F.col("low")).cast("double"))
    grid = ranges.select(
        "label",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        start.alias("start"),
        width.alias("width"),
    )
    spread = F.col("high") - F.col("low")
    offset = (F.col("length") - F.col("low")).cast("long") * bins
    place = F.when(flat, F.lit(bins // 2)).otherwise(
        F.least(((offset - offset % spread) / spread).cast("int"), F.lit(bins - 1))
    )
    filled = (
        counts.join(F.broadcast(ranges), "label")
        .groupBy("label", place.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    return grid.join(F.broadcast(filled), ["label", "bin"], "left").select(
        "label",
        "bin",
        round_half_even(F.col("start") + F.col("width") * F.col("bin") / bins).alias("bin_start"),
        round_half_even(F.col("start") + F.col("width") * (F.col("bin") + 1) / bins).alias(
            "bin_end"
        ),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def head_rows(frame: DataFrame, n: int, order_col: str) -> DataFrame:
    return frame.orderBy(order_col).limit(n)
