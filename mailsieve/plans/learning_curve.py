"""F1 on the training part and by cross-validation for growing training sets, in one pass.

Every row lies in one cell: its fold, and the smallest training set it belongs to (its band).
A run is a size and a held-out fold, so its training set is a union of cells. Nothing is fitted
run by run: texts are tokenised once, terms are counted once by cell, and what a run needs
(frequencies, document counts, class sums) are sums over its cells. Columns of the shared tables
hold one number per run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions.numeric import round_half_even
from mailsieve.operators.evaluation import metrics_from_cells
from mailsieve.operators.linear import MARGIN_PRECISION, Problem, fit_shared, shared_margins
from mailsieve.operators.sampling import seeded_hash
from mailsieve.operators.terms import counted_terms, with_terms
from mailsieve.plans.training import LOSSES, MODEL_NAMES
from mailsieve.schema import ROW_KEY
from mailsieve.session import written

_HASH_RANGE = 1 << 32


def _hash_share(row_key: str, seed: str):
    """A number in [0, 1) per row, from the first eight digits of its hash."""
    digits = F.substring(seeded_hash(F.col(row_key), seed), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(_HASH_RANGE)


@dataclass(frozen=True)
class Run:
    """A training set: rows of other folds than ``held_out`` in the first ``bands`` bands."""

    number: int
    size: float
    held_out: int
    bands: int

    def trains(self) -> Column:
        return (F.col("fold") != self.held_out) & (F.col("band") < self.bands)

    def uses(self) -> Column:
        """Rows that train or validate."""
        return (F.col("fold") == self.held_out) | (F.col("band") < self.bands)

    def cells(self, folds: int) -> list[tuple[int, int]]:
        return [(k, b) for k in range(folds) if k != self.held_out for b in range(self.bands)]


def _array(values: Sequence[Column], kind: str) -> Column:
    return F.array(*[v.cast(kind) for v in values])


# --- what all runs share ----------------------------------------------------


def term_cells(rows: DataFrame, runs: Sequence[Run], folds: int, bands: int) -> DataFrame:
    """term, tf and df (one number per run each): one shuffle by term, combined before it."""
    per_cell = [(k, b) for k in range(folds) for b in range(bands)]

    def here(k: int, b: int) -> Column:
        return (F.col("fold") == k) & (F.col("band") == b)

    counts = (
        rows.where(F.col("band") < bands)
        .select("fold", "band", F.inline("counted"))
        .groupBy("term")
        .agg(
            *[F.sum(F.when(here(k, b), F.col("tf")).otherwise(0)).alias(f"tf_{k}_{b}") for k, b in per_cell],
            *[F.count_if(here(k, b)).alias(f"df_{k}_{b}") for k, b in per_cell],
        )
    )

    def total(run: Run, name: str) -> Column:
        return reduce(Column.__add__, [F.col(f"{name}_{k}_{b}") for k, b in run.cells(folds)])

    return counts.select("term", *[_array([total(r, n) for r in runs], "long").alias(n) for n in ("tf", "df")])


def run_vocabularies(counts: DataFrame, runs: Sequence[Run], rows_of: Sequence[int], max_features: int) -> DataFrame:
    """term, at (its number) and idf (one per run, null where a run's vocabulary lacks it).

    The most frequent terms of each run, ties to the lower term. Counts per frequency tell how
    frequent a term must be, so only terms that can get in are sorted.
    """
    per_frequency = (
        counts.select(F.posexplode("tf").alias("run", "tf")).where("tf > 0").groupBy("run", "tf").agg(F.count(F.lit(1)).alias("n"))
    )
    down = Window.partitionBy("run").orderBy(F.desc("tf"))
    enough = per_frequency.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= max_features)
    lowest = {r.run: r.tf for r in enough.groupBy("run").agg(F.max("tf").alias("tf")).collect()}  # one per run
    chosen = []
    for run in runs:
        tf, df = F.get("tf", F.lit(run.number)), F.get("df", F.lit(run.number))
        idf = F.log((1.0 + rows_of[run.number]) / (1.0 + df.cast("double"))) + 1.0
        best = counts.where(tf >= max(1, lowest.get(run.number, 1))).orderBy(tf.desc(), "term").limit(max_features)
        chosen.append(best.select("term", F.lit(run.number).alias("run"), idf.alias("idf")))
    every = reduce(DataFrame.unionByName, chosen)
    idfs = [F.max(F.when(F.col("run") == r.number, F.col("idf"))) for r in runs]
    # As many rows as runs times features at most.
    number = F.row_number().over(Window.orderBy("term")) - 1
    return every.groupBy("term").agg(_array(idfs, "double").alias("idf")).withColumn("at", number.cast("int"))


def run_vectors(rows: DataFrame, terms: DataFrame, runs: Sequence[Run], row_key: str) -> DataFrame:
    """Each row with its counts of vocabulary terms (at, tf) and the length of its weights per run."""
    placed = rows.select(row_key, "label", "fold", "band", F.inline_outer("counted")).join(
        F.broadcast(terms), "term", "left"  # runs times features rows at most
    )
    squares = [F.sum(F.pow(F.col("tf") * F.get("idf", F.lit(r.number)), 2)) for r in runs]
    entry = F.when(F.col("at").isNotNull(), F.struct("at", "tf"))
    return placed.groupBy(row_key, "label", "fold", "band").agg(
        F.collect_list(entry).alias("entries"),
        _array([F.sqrt(F.coalesce(s, F.lit(0.0))) for s in squares], "double").alias("norm"),
    )


def _per_run(runs: Sequence[Run], value) -> Column:
    """Long form: run and part of every run that uses the row, with ``value(run)``."""
    entries = [
        F.when(
            run.uses(),
            F.struct(
                F.lit(run.number).alias("run"),
                F.when(F.col("fold") == run.held_out, "validation").otherwise("train").alias("part"),
                value(run).alias("value"),
            ),
        )
        for run in runs
    ]
    return F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull()))


# --- models -----------------------------------------------------------------


def _naive_bayes(vectors: DataFrame, terms: DataFrame, runs: Sequence[Run], sizes: dict, row_key: str) -> DataFrame:
    """run, part, label, prediction; class sums and odds of all runs side by side."""
    alpha = settings.NAIVE_BAYES_ALPHA

    def share(run: Run, label: int) -> Column:
        """Of a term's weight without its idf, which is the same in all rows."""
        mine = run.trains() & (F.col("label") == label)
        return F.sum(F.when(mine, F.try_divide(F.col("tf"), F.get("norm", F.lit(run.number)))))

    sums = (
        vectors.select("label", "fold", "band", "norm", F.inline("entries"))
        .groupBy("at")
        .agg(*[_array([share(r, c) for r in runs], "double").alias(f"shares{c}") for c in settings.LABELS])
    )

    def weight(run: Run, label: int) -> Column:
        idf = F.get("idf", F.lit(run.number))
        return F.when(idf.isNotNull(), idf * F.coalesce(F.get(f"shares{label}", F.lit(run.number)), F.lit(0.0)))

    weighted = written(
        terms.join(sums, "at", "left").select(
            "at", "idf", *[_array([weight(r, c) for r in runs], "double").alias(f"weight{c}") for c in settings.LABELS]
        ),
        "curve-weights",
    )
    totals = weighted.agg(
        *[
            f.alias(f"{name}_{r.number}")
            for r in runs
            for name, f in (
                ("v", F.count(F.get("idf", F.lit(r.number)))),
                *((f"t{c}", F.coalesce(F.sum(F.get(f"weight{c}", F.lit(r.number))), F.lit(0.0))) for c in settings.LABELS),
            )
        ]
    ).first()

    def odds(run: Run) -> Column:
        """What a count of 1 adds to the margin, before the division by the row's length."""
        theta = [
            F.log(F.get(f"weight{c}", F.lit(run.number)) + alpha)
            - F.lit(float(np.log(totals[f"t{c}_{run.number}"] + alpha * max(1, totals[f"v_{run.number}"]))))
            for c in settings.LABELS
        ]
        return F.get("idf", F.lit(run.number)) * (theta[1] - theta[0])

    odds_table = weighted.select("at", _array([odds(r) for r in runs], "double").alias("odds"))
    summed = (
        vectors.select(row_key, "label", "fold", "band", "norm", F.inline_outer("entries"))
        .join(F.broadcast(odds_table), "at", "left")  # runs times features rows at most
        .groupBy(row_key, "label", "fold", "band", "norm")
        .agg(_array([F.sum(F.col("tf") * F.get("odds", F.lit(r.number))) for r in runs], "double").alias("margin"))
    )

    def prediction(run: Run) -> Column:
        n = [sizes[run.number][c] for c in settings.LABELS]
        if not all(n):
            return F.lit(int(n[1] > 0))
        margin = F.coalesce(F.try_divide(F.get("margin", F.lit(run.number)), F.get("norm", F.lit(run.number))), F.lit(0.0))
        return (margin + float(np.log(n[1] + alpha) - np.log(n[0] + alpha)) > 0).cast("int")

    return summed.select("label", _per_run(runs, prediction)).withColumnRenamed("value", "prediction")


def _solved(
    vectors: DataFrame, terms: DataFrame, names: Sequence[str], runs: Sequence[Run], sizes: dict, row_key: str
) -> DataFrame:
    """model, run, part, label, prediction; all runs and losses solved in the same passes."""
    two = [r for r in runs if all(sizes[r.number].values())]
    one = [r for r in runs if r not in two]
    found = []
    for name in names if one else ():
        only = _per_run(one, lambda run: F.lit(int(sizes[run.number][1] > 0)))
        found.append(vectors.select(F.lit(name).alias("model"), "label", only).withColumnRenamed("value", "prediction"))
    if two:
        # Rows stand once for all runs: their counts, times the idf and over the length of each run.
        def scale(run: Run) -> Column:
            return F.coalesce(F.try_divide(F.lit(1.0), F.get("norm", F.lit(run.number))), F.lit(0.0))

        rows = vectors.select(
            "label", F.col("entries.at").alias("at"), F.col("entries.tf").cast("array<double>").alias("x"),
            *[F.array(*[F.when(used(r), scale(r)) for r in two]).alias(name) for name, used in (("trains", Run.trains), ("scales", Run.uses))],
            "fold", F.col("label").alias("truth"),
        )
        numbers = [r.number for r in two]
        idf = terms.select("at", *[F.coalesce(F.get("idf", F.lit(n)), F.lit(0.0)).alias(f"idf_{n}") for n in numbers]).toArrow()
        n_features = idf.num_rows
        factors = {n: np.zeros(n_features) for n in numbers}  # one number per run and feature, as the weights
        for n, factor in factors.items():
            factor[idf["at"].to_numpy()] = idf[f"idf_{n}"].to_numpy()
        problems = [Problem(n, LOSSES[name]) for n in numbers for name in names]
        trained = rows.select("label", "at", "x", F.col("trains").alias("scales")).where(F.exists("scales", lambda s: s.isNotNull()))
        solved = fit_shared(trained, numbers, problems, n_features, factors)
        held_out = F.get(F.array(*[F.lit(r.held_out) for r in runs]), F.col("run"))
        scored = shared_margins(rows, numbers, solved, ["truth", "fold"], factors).withColumnRenamed("truth", "label").withColumn(
            "part", F.when(F.col("fold") == held_out, "validation").otherwise("train")
        )
        found.append(
            scored.unpivot(["label", "run", "part"], [LOSSES[n] for n in names], "loss", "margin").select(
                F.element_at(F.create_map(*[F.lit(x) for n in names for x in (LOSSES[n], n)]), F.col("loss")).alias("model"),
                "label", "run", "part", (F.col("margin") > MARGIN_PRECISION).cast("int").alias("prediction"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def learning_curve(
    dataset: DataFrame,
    names: Sequence[str] = tuple(MODEL_NAMES),
    sizes: Sequence[float] = (0.25, 0.5, 1.0),
    folds: int = 3,
    text_col: str = "text",
    max_features: int = settings.MAX_FEATURES,
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    seed: int = settings.SEED,
    row_key: str = ROW_KEY,
) -> DataFrame:
    """One row per model, size, fold and part (``train`` or ``validation``).

    Folds and nested training sets are decided row by row from hashes of the key,
    so no fold needs a shuffle and a smaller set is always part of a larger one.
    Each training set has a vocabulary and weights of its own. A training set of one class
    predicts that class; one without rows gives none.
    """
    growing = sorted(set(sizes))
    fold = F.floor(_hash_share(row_key, f"{seed}:fold") * folds).cast("int")
    place = _hash_share(row_key, f"{seed}:size")
    band = reduce(lambda found, i: F.when(place < growing[i], i).otherwise(found), reversed(range(len(growing))), F.lit(len(growing)))
    placed = dataset.select(row_key, "label", F.col(text_col).alias("text"), fold.alias("fold"), band.alias("band"))
    rows = written(counted_terms(with_terms(placed, "text", ngram_range)).drop("text", "terms"), "curve-rows")

    # Two labels in each cell at most.
    found = rows.groupBy("fold", "band", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    counts_of, runs = {}, []
    for size in sizes:
        for held_out in range(folds):
            run = Run(len(runs), float(size), held_out, growing.index(size) + 1)
            n = {c: sum(r.n for r in found if r.label == c and r.fold != held_out and r.band < run.bands) for c in settings.LABELS}
            if sum(n.values()):
                runs.append(run)
                counts_of[run.number] = n
    if not runs:
        raise ValueError("no training set has a row")
    counts = written(term_cells(rows, runs, folds, len(growing)), "curve-counts")
    terms = written(run_vocabularies(counts, runs, [sum(counts_of[r.number].values()) for r in runs], max_features), "curve-terms")
    vectors = written(run_vectors(rows, terms, runs, row_key), "curve-vectors")

    parts = []
    if "naive_bayes" in names:
        predicted = _naive_bayes(vectors, terms, runs, counts_of, row_key)
        parts.append(predicted.withColumn("model", F.lit("naive_bayes")))
    iterative = [name for name in names if name in LOSSES]
    if iterative:
        parts.append(_solved(vectors, terms, iterative, runs, counts_of, row_key))
    predictions = reduce(DataFrame.unionByName, parts)

    label, guess = F.col("label"), F.col("prediction")
    cells = predictions.groupBy("model", "run", "part").agg(
        F.count_if((label == 0) & (guess == 0)).alias("tn"),
        F.count_if((label == 0) & (guess == 1)).alias("fp"),
        F.count_if((label == 1) & (guess == 0)).alias("fn"),
        F.count_if((label == 1) & (guess == 1)).alias("tp"),
    )

    def of_run(value) -> Column:
        return F.get(F.array(*[F.lit(value(run)) for run in runs]), F.col("run"))

    keys = F.struct(
        "model",
        of_run(lambda r: r.size).alias("size"),
        of_run(lambda r: r.held_out).alias("fold"),
        of_run(lambda r: sum(counts_of[r.number].values())).alias("train_rows"),
        "part",
    )
    packed = cells.withColumn("model", keys).drop("run", "part")
    return metrics_from_cells(packed).select(
        "model.*", round_half_even(F.col("f1_spam")).alias("f1_spam"), "total"
    )


def curve_means(curve: DataFrame) -> DataFrame:
    """Mean F1 over the folds, train beside validation."""
    return curve.groupBy("model", "size").agg(
        F.avg("train_rows").alias("train_rows"),
        *(
            F.avg(F.when(F.col("part") == part, F.col("f1_spam"))).alias(f"{part}_f1")
            for part in ("train", "validation")
        ),
    )
