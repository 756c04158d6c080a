"""Linear classifiers by a distributed generalised Newton method.

Objectives, with y = +1 or -1 and f(x) = w.x + b:

* ``logistic``: |w|^2 / 2 + C * sum log(1 + exp(-y f)), intercept free;
* ``squared_hinge``: (|w|^2 + b^2) / 2 + C * sum max(0, 1 - y f)^2, intercept penalised.

Vectors are stored once, as blocks of arrays that need no conversion, and stand there once for
all runs that share them. A step solves for its direction by conjugate gradients with the
diagonal as preconditioner, each of which is one pass: tasks multiply their rows as arrays and
give back sums by feature in chunks, which are added up by (problem, chunk). No Hessian is built.
The driver holds vectors of one number per feature and problem, never a row.

The Hessian changes little from one step to the next, so the directions that a step tried tell the
next ones about it: they refine the preconditioner (as L-BFGS does with gradients; Morales and
Nocedal 2000). With more rows the diagonal alone needs ever more passes. What is kept of them is
bounded, and decides how fast the solution is reached, never what it is.

Many problems are solved side by side in the same passes: both losses of a training set, and
the training sets (``run``) of a learning curve. A problem that has converged leaves the
passes; one that has not after ``max_steps`` steps is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.session import importable_by_workers, written

LOSSES = ("logistic", "squared_hinge")
#: The gradient has to fall to this share of the first one.
TOLERANCE = 1e-10
#: A margin below this is noise of the solution: texts without a known term in balanced classes.
MARGIN_PRECISION = 1e-9
_CG_STEPS = 250
#: Memory for what all problems together keep of earlier steps.
_KNOWN_BYTES = 160 << 20


@dataclass(frozen=True)
class Problem:
    run: int
    loss: str


@dataclass
class Solution:
    """Weights of a problem; ``gradient`` is the length of the gradient there."""

    weights: np.ndarray
    intercept: float
    steps: int
    passes: int
    gradient: float


def vector_rows(frame: DataFrame, vector_col: str = "features", label_col: str = "label", *keep: str) -> DataFrame:
    """Rows for the solver: run, label, at, x (places and values that are not zero), and ``keep``."""
    parts = frame.withColumn("_parts", F.unwrap_udt(vector_col))
    places = F.coalesce("_parts.indices", F.sequence(F.lit(0), F.size("_parts.values") - 1))
    run = F.col("run") if "run" in frame.columns else F.lit(0)
    return parts.select(
        run.cast("int").alias("run"),
        F.col(label_col).cast("int").alias("label"),
        places.alias("at"),
        F.col("_parts.values").alias("x"),
        *keep,
    )


# --- rows as blocks ----------------------------------------------------------

#: Entries of a block: what is made of them stays in the cache.
_BLOCK_ENTRIES = 1 << 15
_BLOCK = "n int, label binary, scale binary, sizes binary, at binary, x binary"
_KINDS = (np.int8, np.float64, np.int32, np.int32, np.float64)


def _lists(column: pa.Array, kind: type) -> np.ndarray:
    """All values of a list column; nulls of numbers become NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _blocks(batches: Iterator[pa.RecordBatch], apart: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (label, at, x, scales) as blocks of arrays; ``apart``: a block holds rows of the same runs."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int8)
        sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int32)
        at, x = _lists(batch.column(1), np.int32), _lists(batch.column(2), np.float64)
        scale = _lists(batch.column(3), np.float64).reshape(batch.num_rows, -1)
        ends = np.cumsum(sizes, dtype=np.int64)
        unused = np.isnan(scale)
        cuts = [*(np.flatnonzero((unused[1:] != unused[:-1]).any(axis=1)) + 1), batch.num_rows] if apart else [batch.num_rows]
        a = 0
        while a < batch.num_rows:
            first = ends[a] - sizes[a]
            b = max(a + 1, int(np.searchsorted(ends, first + _BLOCK_ENTRIES, "right")))
            b = min(b, int(cuts[np.searchsorted(cuts, a, "right")]))
            part = slice(first, ends[b - 1])
            arrays = (label[a:b], scale[a:b], sizes[a:b], at[part], x[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b - a], pa.int32()), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in arrays)],
                [field.split()[0] for field in _BLOCK.split(", ")],
            )
            a = b


def stored_blocks(rows: DataFrame) -> DataFrame:
    """Rows (label, at, x, scales) stored as blocks that the passes multiply as they are.

    ``scales`` holds a number per run: what the row is multiplied by there, null where the run
    leaves it out. So a row that many runs share is stored, read and sent to Python once. Rows of
    the same runs stand together, and a run skips the blocks that it leaves out.
    """
    importable_by_workers(rows.sparkSession)
    chosen = rows.select("label", "at", "x", "scales")
    together = chosen.sortWithinPartitions(F.transform("scales", lambda scale: scale.isNull()))
    packed = together.mapInArrow(lambda batches: _blocks(batches, apart=True), _BLOCK)
    # Floats hardly shrink, and every pass would unpack them again.
    return written(packed, "solver-blocks", compression="uncompressed", **{"parquet.block.size": 1 << 25})


class _Rows:
    """A block as a sparse matrix whose rows stand once for all runs."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.n = batch.column(0)[i].as_py()
        label, scale, sizes, at, self.x = (
            np.frombuffer(batch.column(k + 1)[i].as_buffer(), kind) for k, kind in enumerate(_KINDS)
        )
        self.at = at.astype(np.int64)  # numpy's own kind of index
        self.y = 2.0 * label - 1.0
        scale = np.ascontiguousarray(scale.reshape(self.n, -1).T)
        self.used = ~np.isnan(scale)
        self.scale = np.where(self.used, scale, 0.0)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.filled = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes, dtype=np.int64) - sizes)[self.filled]

    def times(self, w: np.ndarray, run: int) -> np.ndarray:
        """Rows times the weights under the run at this place; the last weight is the intercept."""
        found = np.zeros(self.n)
        if len(self.at):
            found[self.filled] = np.add.reduceat(w.take(self.at) * self.x, self.starts)
        return found * self.scale[run] + w[-1]

    def back(self, u: np.ndarray, run: int, out: np.ndarray, power: int = 1) -> None:
        """Add the sum over rows of u times the row (to a power) to ``out``, the intercept last."""
        entries = (u * self.scale[run] ** power).take(self.row) * (self.x if power == 1 else self.x**power)
        np.add.at(out, self.at, entries)
        out[-1] += u.sum()


def _slopes(loss: str, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, first and second derivative at z = y f."""
    if loss == "logistic":
        p = np.exp(-np.logaddexp(0, z))  # 1 / (1 + e^z)
        return np.logaddexp(0, -z), -p, p * (1 - p)
    short = np.maximum(0, 1 - z)
    return short * short, -2 * short, 2.0 * (short > 0)


# --- one pass ---------------------------------------------------------------


def _summed(blocks: DataFrame, slots: int, per_block: Callable) -> np.ndarray:
    """One pass: ``per_block(rows, sums)`` adds to sums[problem, slot]; returns their total."""
    spark = blocks.sparkSession
    importable_by_workers(spark)
    problems = per_block.problems

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((problems, slots))
        for batch in batches:
            for i in range(batch.num_rows):
                per_block(_Rows(batch, i), sums)
        for problem in range(problems):
            for at in range(0, slots, _CHUNK):
                part = sums[problem, at : at + _CHUNK]
                if part.any():
                    yield _chunk(problem, at, part)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for key, part in _chunks(batches):
            totals[key] = totals[key] + part if key in totals else part
        for key, part in totals.items():
            yield _chunk(*key, part)

    parts = blocks.mapInArrow(work, _CHUNKS).repartition("problem", "at")
    total = np.zeros((problems, slots))
    # One number per problem and feature.
    for (problem, at), part in _chunks(parts.mapInArrow(added, _CHUNKS).toArrow().to_batches()):
        total[problem, at : at + len(part)] = part
    return total


#: Sums travel in chunks of so many: a row for each would cost more than what it is made from.
_CHUNK = 1 << 12
_CHUNKS = "problem int, at int, x binary"


def _chunk(problem: int, at: int, part: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([problem], pa.int32()), pa.array([at], pa.int32()), pa.array([part.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["problem", "at", "x"])


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column(0)[i].as_py(), batch.column(1)[i].as_py()), np.frombuffer(batch.column(2)[i].as_buffer())


class _Evaluate:
    """Adds up gradient, diagonal of the Hessian and loss of the data part."""

    def __init__(self, states: Sequence[_State], shared):
        self.losses, self.runs = [s.problem.loss for s in states], [s.place for s in states]
        self.problems, self.shared = len(states), shared

    def __call__(self, rows: _Rows, sums: np.ndarray) -> None:
        points = self.shared.value
        width = points.shape[1]
        for i, (kind, run) in enumerate(zip(self.losses, self.runs, strict=True)):
            used = rows.used[run]
            if not used.any():
                continue
            loss, first, second = _slopes(kind, rows.y * rows.times(points[i], run))
            rows.back(rows.y * first * used, run, sums[i, :width])
            rows.back(second * used, run, sums[i, width : 2 * width], power=2)
            sums[i, 2 * width] += loss[used].sum()


class _Curvature:
    """Adds up the Hessian of the data part times a direction."""

    def __init__(self, states: Sequence[_State], shared):
        self.losses, self.runs = [s.problem.loss for s in states], [s.place for s in states]
        self.problems, self.shared = len(states), shared

    def __call__(self, rows: _Rows, sums: np.ndarray) -> None:
        points, directions = self.shared.value
        for i, (kind, run) in enumerate(zip(self.losses, self.runs, strict=True)):
            if not rows.used[run].any():
                continue
            _, _, second = _slopes(kind, rows.y * rows.times(points[i], run))
            rows.back(second * rows.used[run] * rows.times(directions[i], run), run, sums[i])


# --- Newton -----------------------------------------------------------------


class _State:
    """A problem on its way; ``place`` is the place of its run among the scales of a row."""

    def __init__(self, problem: Problem, place: int, factor: np.ndarray, weight: float):
        width = len(factor)
        self.problem, self.place, self.factor, self.weight = problem, place, factor, weight
        self.w = np.zeros(width)
        # The penalty on each weight; the logistic intercept has none.
        self.penalty = np.ones(width)
        self.penalty[-1] = float(problem.loss == "squared_hinge")
        self.steps = self.passes = 0
        self.first: float | None = None
        # Features that the run has; the others keep a weight of 0.
        self.own = np.flatnonzero(factor)
        # Directions of earlier steps, the Hessian times each, and 1 over the product of both.
        self.known: list[tuple[np.ndarray, np.ndarray, float]] = []

    def take(self, w: np.ndarray, sums: np.ndarray) -> None:
        """Move to ``w``, where the data part has these sums."""
        self.w = w
        self.value, self.gradient, self.diagonal = self.measure(w, sums)
        self.size = float(np.linalg.norm(self.gradient))
        self.first = self.size if self.first is None else self.first

    def measure(self, w: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        width = len(w)
        value = self.weight * sums[2 * width] + 0.5 * float(np.dot(self.penalty * w, w))
        gradient = self.weight * self.factor * sums[:width] + self.penalty * w
        diagonal = np.maximum(self.weight * self.factor**2 * sums[width : 2 * width] + self.penalty, 1e-12)
        return value, gradient, diagonal

    def learn(self, tried: Sequence[tuple[np.ndarray, np.ndarray]], most: int) -> None:
        """Keep the last ``most`` pairs of a direction and the Hessian times it."""
        for way, bent in tried[-most:]:
            inner = float(np.dot(way, bent))
            if inner > 0:
                self.known.append((way, bent, 1.0 / inner))
        self.known = self.known[-most:]

    def preconditioned(self, vector: np.ndarray) -> np.ndarray:
        """About the inverse Hessian times ``vector``."""
        if not self.known:
            return vector / self.diagonal
        left, shares = vector[self.own], []
        for way, bent, share in reversed(self.known):
            shares.append(share * np.dot(way, left))
            left -= shares[-1] * bent
        found = left / self.diagonal[self.own]
        for (way, bent, share), before in zip(self.known, reversed(shares), strict=True):
            found += (before - share * np.dot(bent, found)) * way
        whole = np.zeros_like(vector)
        whole[self.own] = found
        return whole

    @property
    def done(self) -> bool:
        return self.size <= TOLERANCE * max(1.0, self.first)


def _scaled(states: Sequence[_State], vectors: Sequence[np.ndarray]) -> np.ndarray:
    """Vectors of all states, times the factors of their run's features."""
    return np.array([s.factor * v for s, v in zip(states, vectors, strict=True)])


def _evaluated(blocks: DataFrame, states: list[_State], points: list[np.ndarray]) -> np.ndarray:
    shared = blocks.sparkSession.sparkContext.broadcast(_scaled(states, points))
    sums = _summed(blocks, 2 * len(points[0]) + 1, _Evaluate(states, shared))
    shared.destroy()
    for state in states:
        state.passes += 1
    return sums


def _directions(blocks: DataFrame, states: list[_State]) -> list[np.ndarray]:
    """Newton directions by conjugate gradients, all states in the same passes."""
    found = [np.zeros_like(s.w) for s in states]
    left = [-s.gradient for s in states]
    scaled = [s.preconditioned(r) for r, s in zip(left, states, strict=True)]
    most = max(1, _KNOWN_BYTES // sum(16 * len(s.own) for s in states))
    tried: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in states]
    ways = [z.copy() for z in scaled]
    reach = [float(np.dot(r, z)) for r, z in zip(left, scaled, strict=True)]
    # No further than the whole solution has to go.
    goal = [max(s.size * min(0.1, (s.size / s.first) ** 0.5), 0.3 * TOLERANCE * max(1.0, s.first)) for s in states]
    active = list(range(len(states)))
    for _ in range(_CG_STEPS):
        if not active:
            break
        some = [states[i] for i in active]
        pair = _scaled(some, [s.w for s in some]), _scaled(some, [ways[i] for i in active])
        shared = blocks.sparkSession.sparkContext.broadcast(pair)
        sums = _summed(blocks, len(some[0].w), _Curvature(some, shared))
        shared.destroy()
        still = []
        for i, data in zip(active, sums, strict=True):
            state = states[i]
            state.passes += 1
            bent = state.weight * state.factor * data + state.penalty * ways[i]
            curve = float(np.dot(ways[i], bent))
            if curve <= 0:  # flat along an unpenalised intercept
                continue
            tried[i].append((ways[i][state.own], bent[state.own]))
            del tried[i][:-most]
            step = reach[i] / curve
            found[i] += step * ways[i]
            left[i] -= step * bent
            if np.linalg.norm(left[i]) <= goal[i]:
                continue
            scaled[i] = state.preconditioned(left[i])
            new = float(np.dot(left[i], scaled[i]))
            ways[i] = scaled[i] + new / reach[i] * ways[i]
            reach[i] = new
            still.append(i)
        active = still
    for state, pairs in zip(states, tried, strict=True):
        state.learn(pairs, most)
    return found


def _advance(blocks: DataFrame, states: list[_State], directions: list[np.ndarray]) -> None:
    """Go as far along each direction as lowers the objective: whole steps, else halves."""
    todo = [(s, d, 1.0) for s, d in zip(states, directions, strict=True)]
    while todo:
        points = [s.w + t * d for s, d, t in todo]
        sums = _evaluated(blocks, [s for s, _, _ in todo], points)
        again = []
        for (state, way, t), point, row in zip(todo, points, sums, strict=True):
            value, gradient, _ = state.measure(point, row)
            lower = value <= state.value + 1e-4 * t * float(np.dot(state.gradient, way))
            # So near the end that rounding hides the decrease, the gradient tells.
            level = abs(value - state.value) <= 1e-12 * max(1.0, abs(state.value))
            if lower or (level and np.linalg.norm(gradient) < state.size) or t < 1e-6:
                state.take(point, row)
                state.steps += 1
            else:
                again.append((state, way, t / 2))
        todo = again


def fit_linear(
    rows: DataFrame,
    problems: Sequence[Problem],
    n_features: int,
    weight: float = settings.INVERSE_REGULARISATION,
    max_steps: int | None = None,
) -> dict[Problem, Solution]:
    """Solve all ``problems`` over ``rows`` (run, label, at, x)."""
    runs = sorted({p.run for p in problems})
    scales = F.array(*[F.when(F.col("run") == run, F.lit(1.0)) for run in runs])
    mine = rows.where(F.col("run").isin(runs)).withColumn("scales", scales)
    return fit_shared(mine, runs, problems, n_features, None, weight, max_steps)


def fit_shared(
    rows: DataFrame,
    runs: Sequence[int],
    problems: Sequence[Problem],
    n_features: int,
    factors: dict[int, np.ndarray] | None = None,
    weight: float = settings.INVERSE_REGULARISATION,
    max_steps: int | None = None,
) -> dict[Problem, Solution]:
    """Solve all ``problems`` over rows (label, at, x, scales) that ``runs`` share.

    In a run, a row counts times its scale there, and each feature times the run's factor.
    """
    limit = settings.SOLVER_MAX_STEPS if max_steps is None else max_steps

    def factor(run: int) -> np.ndarray:
        return np.append(np.ones(n_features) if factors is None else factors[run], 1.0)

    states = [_State(p, list(runs).index(p.run), factor(p.run), weight) for p in problems]
    if not states:
        return {}
    blocks = stored_blocks(rows)
    for state, sums in zip(states, _evaluated(blocks, states, [s.w for s in states]), strict=True):
        state.take(state.w, sums)
    active = [s for s in states if not s.done]
    while active:
        late = [s for s in active if s.steps >= limit]
        if late:
            raise RuntimeError(f"{late[0].problem.loss} did not converge in {limit} steps")
        _advance(blocks, active, _directions(blocks, active))
        active = [s for s in active if not s.done]
    return {s.problem: Solution(s.w[:-1], float(s.w[-1]), s.steps, s.passes, s.size) for s in states}


def margins(rows: DataFrame, solutions: dict[Problem, Solution], keep: Sequence[str]) -> DataFrame:
    """``keep``, run and, for each loss, the margin of each row under its run's solution.

    ``keep`` are columns of ``rows`` beside run, at and x.
    """
    runs = sorted({p.run for p in solutions})
    scales = F.array(*[F.when(F.col("run") == run, F.lit(1.0)) for run in runs])
    return shared_margins(rows.withColumn("scales", scales), runs, solutions, keep)


def shared_margins(
    rows: DataFrame,
    runs: Sequence[int],
    solutions: dict[Problem, Solution],
    keep: Sequence[str],
    factors: dict[int, np.ndarray] | None = None,
) -> DataFrame:
    """As ``margins``, for rows (label, at, x, scales) that ``runs`` share: one for each row and run of it."""
    spark = rows.sparkSession
    importable_by_workers(spark)
    losses = list(dict.fromkeys(p.loss for p in solutions))

    def scoring(run: int, loss: str) -> np.ndarray:
        s = solutions[Problem(run, loss)]
        return np.append(s.weights if factors is None else factors[run] * s.weights, s.intercept)

    shared = spark.sparkContext.broadcast({(run, loss): scoring(run, loss) for loss in losses for run in runs})
    number = np.array(runs, np.int32)
    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in _blocks(iter([batch.select(range(4))])):
                matrix = _Rows(block, 0)
                run, row = np.nonzero(matrix.used)
                kept = pa.RecordBatch.from_arrays(batch.columns[4:], list(keep)).take(pa.array(row + done)).columns if keep else []
                margin = [
                    pa.array(np.array([matrix.times(shared.value[r, loss], k) for k, r in enumerate(runs)])[run, row]) for loss in losses
                ]
                yield pa.RecordBatch.from_arrays([pa.array(number[run]), *kept, *margin], ["run", *keep, *losses])
                done += matrix.n

    chosen = rows.select("label", "at", "x", "scales", *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)])
    return chosen.mapInArrow(work, f"run int, {schema}" + ", ".join(f"{loss} double" for loss in losses))
