"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, in blocks: queries are cut into blocks of about
``BLOCK_BYTES``, and a block goes to all tasks, which multiply it with the vectors where they
lie. Vectors are never shuffled or repeated, and scores are never stored. Instead rounds of
histograms locate the k-th score of each query, one pass over the vectors a round:

1. A round splits the range that holds the k-th score into 2 ** ``BITS`` bins, counts the
   scores of each slice of vectors by bin, adds the counts up over all slices, and narrows the
   range to the bin where the running count reaches k. A slice sends only its bins down to its
   own k-th score: the k-th score over all slices is not below that, so nothing that counts
   is left out and a slice sends at most k bins per query.
2. When the range is one score wide, the same rounds over the vector ids of the scores
   equal to it find the last id that is still needed, for queries with more ties than places.
3. A last round keeps what is above both limits and ranks it.

Scores are integers, so all of this is exact. The range starts at the product of the two
largest norms, which bounds the inner product of any two rows, or at the range of a long.
Products are added up as longs, whose sums are right whenever the score fits a long. Where a
score in doubles, with its largest error, does not prove that it fits, the pair is scored in
Python integers.

Defined results: rows with a null id, a null vector, or null, NaN or infinite components
take no part; all finite ones do. As in the SQL, a component whose floor does not fit a
long is an error. So is a score of a candidate above a long; one below a long ranks last and
is an error only if it would be among the results. Vectors of different lengths have no score with each other. Rows with a query's own
id are not its candidates. Rows that repeat an id are candidates, and queries, one by
one. A query with fewer candidates than k gets all. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve.llm.common import worker_path, written
from mailsieve.session import scratch_path

K = 10
SCALE = 1024
BITS = 11
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1
BLOCK_BYTES = 16 << 20
#: Scores of one multiplication: queries times vectors.
_TILE = (1024, 4096)


def _floor(x: Column) -> Column:
    fits = (x >= float(LEAST_LONG)) & (x < -float(LEAST_LONG))
    return F.when(fits, F.floor(x).cast("bigint")).otherwise(
        F.raise_error(F.lit("a scaled component of a vector does not fit a long")).cast("bigint")
    )


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v (floor of scale times each component), dim; only rows that take part."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    return (
        vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), values.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
        .where(F.forall("x", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))))
        .select("vec_id", F.transform("x", lambda x: _floor(x * scale)).alias("v"))
        .withColumn("dim", F.size("v"))
    )


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)


def _scores(vectors: pa.Table, queries: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries x vectors) scores, which of them are candidates, and which are below a long."""
    dim = vectors.column("dim")[0].as_py()
    a, b = _matrix(queries, dim).astype(np.int64), _matrix(vectors, dim).astype(np.int64)
    other = queries.column("query_id").to_numpy()[:, None] != vectors.column("vec_id").to_numpy()[None, :]
    x, y = a.astype(np.float64), b.astype(np.float64)
    largest = float(np.abs(x).max()) * float(np.abs(y).max()) * dim if dim else 0.0
    # Sums below 2 ** 53 are exact in doubles, whose products are much faster.
    if largest < 2.0**53:
        return (x @ y.T).astype(np.int64), other, np.zeros(other.shape, bool)
    scores, below = a @ b.T, np.zeros(other.shape, bool)
    if largest >= 2.0**62:
        _mend(scores, below, a, b, x, y, other)
    return scores, other, below


def _mend(scores, below, a, b, x, y, other) -> None:
    """Set the scores of candidates that may not fit a long, where the sum of longs may be wrong."""
    rough = x @ y.T
    # Twice the error of rounding each component, product and sum.
    error = (len(x[0]) + 8) * 2.0**-51 * np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    below |= other & (rough + error < LEAST_LONG)
    scores[below] = LEAST_LONG
    for i, j in np.argwhere(other & ~below & (np.abs(rough) + error >= -LEAST_LONG)).tolist():
        score = sum(p * q for p, q in zip(a[i].tolist(), b[j].tolist(), strict=True))
        if score > MOST_LONG:
            raise OverflowError("the score of two vectors does not fit a long")
        below[i, j] = score < LEAST_LONG
        scores[i, j] = max(score, LEAST_LONG)


def _histogram(vectors: pa.Table, queries: pa.Table, bits: int) -> pa.Table:
    scores, counted, _ = _scores(vectors, queries)
    low = queries.column("low").to_numpy()[:, None].astype(np.int64)
    high = queries.column("high").to_numpy()[:, None].astype(np.int64)
    shift = queries.column("shift").to_numpy()[:, None].astype(np.uint64)
    by_id = queries.column("by_id").to_numpy(zero_copy_only=False)[:, None].astype(bool)
    need = queries.column("need").to_numpy()
    ids = np.broadcast_to(vectors.column("vec_id").to_numpy()[None, :], scores.shape)
    limit = queries.column("score").to_numpy(zero_copy_only=False)[:, None].astype(np.int64)
    counted &= np.where(by_id, (scores == limit) & (ids >= low) & (ids <= high), (scores >= low) & (scores <= high))
    # Unsigned differences are right even where the range is wider than a signed long.
    ahead = np.where(by_id, ids.astype(np.uint64) - low.astype(np.uint64), high.astype(np.uint64) - scores.astype(np.uint64))
    bins = (ahead >> shift).astype(np.int64)
    rows, places = np.nonzero(counted)
    counts = np.bincount((rows << bits) + bins[rows, places], minlength=len(need) << bits).reshape(len(need), -1)
    # Bins past the one where this block alone has enough are of no use.
    before = np.cumsum(counts, axis=1) - counts
    rows, places = np.nonzero((counts > 0) & (before < need[:, None]))
    return pa.table(
        {
            "qrow": queries.column("qrow").to_numpy()[rows],
            "bin": places.astype(np.int64),
            "n": counts[rows, places].astype(np.int64),
        }
    )


def _winners(vectors: pa.Table, queries: pa.Table) -> pa.Table:
    scores, wanted, below = _scores(vectors, queries)
    ids = vectors.column("vec_id").to_numpy()
    limit = queries.column("score").to_numpy()[:, None]
    last = queries.column("last_id").to_numpy()[:, None]
    rows, places = np.nonzero(wanted & ((scores > limit) | ((scores == limit) & (ids[None, :] <= last))))
    if below[rows, places].any():
        raise OverflowError("a score among the results is below a long")
    return pa.table(
        {
            "qrow": queries.column("qrow").to_numpy()[rows],
            "query_id": queries.column("query_id").to_numpy()[rows],
            "vec_id": ids[places],
            "score": scores[rows, places],
        }
    )


def _by_dim(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, table.filter(pa.array(dims == dim))


def _over_vectors(vectors: DataFrame, queries: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every tile of vectors and queries of the same length, in one pass over the vectors.

    ``queries`` is one block, whose size is bounded; it is sent to the tasks as it is now.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(queries.toArrow())

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = {dim: [t.slice(a, _TILE[0]) for a in range(0, t.num_rows, _TILE[0])] for dim, t in _by_dim(shared.value)}
        for batch in batches:
            for dim, table in _by_dim(pa.Table.from_batches([batch])):
                for a in range(0, table.num_rows, _TILE[1]):
                    for block in mine.get(dim, ()):
                        yield from work(table.slice(a, _TILE[1]), block).to_batches()

    return vectors.select("vec_id", "v", "dim").mapInArrow(tiles, schema)


def _narrowed(state: DataFrame, counts: DataFrame, shift: int) -> DataFrame:
    """The state with its range narrowed to the bin in which the count of places is reached."""
    running = Window.partitionBy("qrow").orderBy("bin")
    reached = (
        counts.groupBy("qrow", "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("reached", F.sum("n").over(running))
        .join(state.select("qrow", "need"), "qrow")
        .where((F.col("reached") >= F.col("need")) & (F.col("reached") - F.col("n") < F.col("need")))
        .select("qrow", "bin", F.col("n").alias("in_bin"), (F.col("reached") - F.col("n")).alias("ahead"))
    )
    # In decimals, as a bin may reach past the end of the range, also of a long.
    wide = "decimal(38,0)"
    width = F.lit(1 << shift).cast(wide)
    first = F.col("bin").cast(wide) * width
    from_low = F.col("low").cast(wide) + first
    from_high = F.col("high").cast(wide) - first
    short = F.col("bin").isNull()
    return state.drop("in_bin").join(reached, "qrow", "left").select(
        "qrow",
        "by_id",
        "score",
        F.when(short, F.col("low"))
        .when(F.col("by_id"), from_low)
        .otherwise(F.greatest(F.col("low").cast(wide), from_high - width + 1))
        .cast("bigint")
        .alias("low"),
        F.when(short, F.col("high"))
        .when(F.col("by_id"), F.least(F.col("high").cast(wide), from_low + width - 1))
        .otherwise(from_high)
        .cast("bigint")
        .alias("high"),
        (F.col("need") - F.coalesce("ahead", F.lit(0))).alias("need"),
        F.coalesce("in_bin", F.lit(0)).alias("in_bin"),
        (F.col("short") | short).alias("short"),
    )


def _locate(vectors: DataFrame, queries: DataFrame, state: DataFrame, span: int, bits: int) -> DataFrame:
    """Rounds of histograms until the range of every query is one value wide."""
    width = max(1, int(span).bit_length())
    while width > 0:
        shift = max(0, width - bits)
        now = state.where("not short").withColumn("shift", F.lit(shift))
        counts = _over_vectors(
            vectors, queries.join(now, "qrow"), lambda a, b: _histogram(a, b, bits), "qrow bigint, bin bigint, n bigint"
        )
        state = written(_narrowed(state, counts, shift), "topk-state")
        width = shift
    return state


def search(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    bits: int = BITS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest scores of each query row.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = vectors.sparkSession
    worker_path(spark)
    row_no = F.monotonically_increasing_id()
    all_rows = written(integer_vectors(vectors, id_col, vector_col, scale).withColumn("row_no", row_no), "topk-vectors")
    facts = all_rows.agg(
        F.min("vec_id"), F.max("vec_id"), F.sum(F.when(is_query, F.col("dim") + 16)).alias("numbers")
    ).first()
    least_id, most_id, numbers = [x or 0 for x in facts]
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norms = [r.square**0.5 for r in all_rows.select(squares.alias("square")).orderBy(F.desc("square")).limit(2).collect()]
    # Rounded up by far more than doubles can be off.
    bound = int(norms[0] * norms[-1] * (1 + 1e-6)) + 1 if norms else 0
    n_blocks = max(1, -(-8 * numbers // block_bytes))
    queries = written(
        all_rows.where(is_query).select(
            F.col("row_no").alias("qrow"),
            F.col("vec_id").alias("query_id"),
            "v",
            "dim",
            F.expr(f"cast(pmod(xxhash64(row_no), {n_blocks}) as int)").alias("block"),
        ),
        "topk-queries",
    )
    limits = max(-bound, LEAST_LONG), min(bound, MOST_LONG), least_id, most_id
    paths = []
    for block in range(n_blocks):
        found = _search_block(all_rows, queries.where(F.col("block") == block).drop("block"), k, bits, *limits)
        paths.append(scratch_path(spark, "topk-results"))
        found.write.parquet(paths[-1])
    return spark.read.schema(found.schema).parquet(*paths)


def _search_block(
    vectors: DataFrame, queries: DataFrame, k: int, bits: int, low: int, high: int, least_id: int, most_id: int
) -> DataFrame:
    """The results of one block of queries; scores lie between ``low`` and ``high``."""
    start = queries.select(
        "qrow",
        F.lit(False).alias("by_id"),
        F.lit(0).cast("bigint").alias("score"),
        F.lit(low).cast("bigint").alias("low"),
        F.lit(high).cast("bigint").alias("high"),
        F.lit(k).cast("bigint").alias("need"),
        F.lit(0).cast("bigint").alias("in_bin"),
        F.lit(False).alias("short"),
    )
    scored = _locate(vectors, queries, start, high - low, bits)
    least, most = F.lit(LEAST_LONG).cast("bigint"), F.lit(MOST_LONG).cast("bigint")
    # A query with too few candidates takes all of them, one with as many ties as places all ties.
    settled = scored.select(
        "qrow",
        "need",
        F.when(F.col("short"), least).otherwise(F.col("low")).alias("score"),
        (~F.col("short") & (F.col("in_bin") > F.col("need"))).alias("tied"),
    )
    tied = settled.where("tied").select(
        "qrow",
        F.lit(True).alias("by_id"),
        "score",
        F.lit(least_id).cast("bigint").alias("low"),
        F.lit(most_id).cast("bigint").alias("high"),
        "need",
        F.lit(0).cast("bigint").alias("in_bin"),
        F.lit(False).alias("short"),
    )
    limits = settled.select("qrow", "score", most.alias("last_id"))
    if not tied.isEmpty():
        found = _locate(vectors, queries, tied, most_id - least_id + 1, bits)
        limits = settled.join(found.select("qrow", F.col("high").alias("last")), "qrow", "left").select(
            "qrow", "score", F.coalesce("last", most).alias("last_id")
        )
    kept = _over_vectors(
        vectors, queries.join(limits, "qrow"), _winners, "qrow bigint, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("qrow").orderBy(F.desc("score"), "vec_id")
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
