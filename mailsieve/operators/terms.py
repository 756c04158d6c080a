"""Words, n-grams, vocabulary and TF-IDF weights."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions import patterns as P
from mailsieve.functions.features import MANUAL_FEATURES
from mailsieve.functions.text import stopword_list
from mailsieve.operators.running import totals_before
from mailsieve.session import importable_by_workers, written


def _grams_sql(n: int) -> str:
    """Runs of ``n`` neighbouring words, joined by a blank."""
    if n == 1:
        return "_words"
    shorter = _grams_sql(n - 1)
    starts = f"slice({shorter}, 1, greatest(size({shorter}) - 1, 0))"
    ends = f"slice(_words, {n}, greatest(size(_words) - {n - 1}, 0))"
    return f"zip_with({starts}, {ends}, (a, b) -> concat(a, ' ', b))"


def _words_sql(text_col: str) -> str:
    """The lower-cased words of a text, stop words among them."""
    return f"regexp_extract_all(lower(coalesce({text_col}, '')), r'{P.WORD}', 0)"


def term_stage(
    text_col: str = "text",
    output_col: str = "terms",
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    stopwords: Iterable[str] | None = None,
) -> SQLTransformer:
    """Text to an array of terms: lower-cased words without stop words, and n-grams of them.

    The same stage makes the vocabulary and, stored with a model, the vectors.
    """
    stop = stopword_list("english") if stopwords is None else stopwords
    # Entries that are not a single word, such as "don't", can never match one.
    listed = ", ".join(f"'{word}'" for word in stop if re.fullmatch(r"\w+", word))
    words = _words_sql(text_col)
    if listed:
        words = f"filter({words}, word -> word NOT IN ({listed}))"
    low, high = ngram_range
    grams = ", ".join(_grams_sql(n) for n in range(low, high + 1))
    return SQLTransformer(
        statement=f"""
        SELECT * EXCEPT (_words), concat({grams}) AS {output_col}
        FROM (SELECT *, {words} AS _words FROM __THIS__)"""
    )


def with_terms(
    frame: DataFrame,
    text_col: str = "text",
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    stopwords: Iterable[str] | None = None,
) -> DataFrame:
    """Add the array column ``terms``."""
    return term_stage(text_col, "terms", ngram_range, stopwords).transform(frame)


def counted_terms(frame: DataFrame) -> DataFrame:
    """Add ``counted``: each text's distinct terms with their occurrences (term, tf).

    In the sorted terms of a text the runs of equal ones are its counts, so nothing is grouped.
    """
    ordered = frame.withColumn("_sorted", F.sort_array("terms"))
    starts = F.filter(
        F.transform("_sorted", lambda term, i: F.when((i == 0) | (F.get("_sorted", i - 1) != term), i)),
        lambda i: i.isNotNull(),
    )
    began = ordered.withColumn("_starts", starts)
    counted = F.transform(
        "_starts",
        lambda start, j: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_starts", j + 1), F.size("_sorted")) - start).alias("tf"),
        ),
    )
    return began.withColumn("counted", counted).drop("_sorted", "_starts")


def _counts_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of terms to the distinct terms of each batch, with occurrences and number of texts."""
    for batch in batches:
        lists = batch.column(0)
        coded = lists.flatten().dictionary_encode()
        n = len(coded.dictionary)
        if not n:
            continue
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        # Equal numbers stand for equal terms of one text.
        pairs = np.repeat(np.arange(len(sizes), dtype=np.int64) * n, sizes) + code
        pairs.sort()
        firsts = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
        tf, df = np.bincount(code, minlength=n), np.bincount(firsts % n, minlength=n)
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(tf), pa.array(df)], ["term", "tf", "df"])


def term_counts(frame: DataFrame) -> DataFrame:
    """Occurrences and number of texts per term, from one shuffle by term.

    Terms are combined per batch of texts before they become rows, and per task before the
    shuffle: a row per occurrence would cost several times what finding the terms does.
    """
    importable_by_workers(frame.sparkSession)
    combined = frame.select("terms").mapInArrow(_counts_of_batches, "term string, tf bigint, df bigint")
    return combined.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _bucket_counts(frame: DataFrame, buckets: int) -> DataFrame:
    """Occurrences per hash bucket of their terms: bucket and n, where there are any.

    Only the numbers of the buckets leave the JVM; a task holds one count for each.
    """
    importable_by_workers(frame.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            number = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(number.astype(np.int64), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    numbers = frame.select(F.transform("terms", lambda term: _bucket(term, buckets).cast("int")).alias("number"))
    return numbers.mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets))


def _bitmap(chosen: DataFrame, buckets: int) -> np.ndarray:
    """The numbers of the ``chosen`` buckets as bits of fixed length."""
    words = np.zeros(max(1, buckets // 64), np.uint64)
    numbers = chosen.select("bucket").toArrow()["bucket"].to_numpy()
    np.bitwise_or.at(words, numbers // 64, np.uint64(1) << (numbers % 64).astype(np.uint64))
    return words


def _only_buckets(frame: DataFrame, chosen: DataFrame, buckets: int) -> DataFrame:
    """Terms of the ``chosen`` buckets."""
    words = _bitmap(chosen, buckets)
    # One literal, folded to an array when the query is optimised.
    bitmap = F.split(F.lit(",".join(map(str, words.view(np.int64).tolist()))), ",").cast("array<bigint>")

    def is_chosen(term: Column) -> Column:
        bucket = _bucket(term, buckets)
        return F.getbit(F.get(bitmap, F.shiftright(bucket, 6).cast("int")), bucket.bitwiseAND(F.lit(63)).cast("int")) == 1

    return frame.withColumn("terms", F.filter("terms", is_chosen))


#: Bits of the longest bitmap of terms, as a power of two: half a megabyte.
_MOST_BUCKET_BITS = 22


def only_terms_of(frame: DataFrame, known: DataFrame) -> DataFrame:
    """Drop most of the ``terms`` that are not in ``known`` (term), and none that is.

    The bitmap has sixteen bits a term up to a fixed length, beyond which it lets more through.
    """
    buckets = 1 << min(_MOST_BUCKET_BITS, max(10, (16 * known.count()).bit_length()))
    return _only_buckets(frame, known.select(_bucket(F.col("term"), buckets).alias("bucket")).distinct(), buckets)


def vocabulary(frame: DataFrame, max_features: int = settings.MAX_FEATURES) -> DataFrame:
    """The ``max_features`` most frequent ``terms``; ties go to the lower term."""

    def counts(chosen: DataFrame | None, buckets: int) -> DataFrame:
        return term_counts(frame if chosen is None else _only_buckets(frame, chosen, buckets))

    return _by_sketch(lambda buckets: _bucket_counts(frame, buckets), counts, max_features)


def text_vocabulary(
    frame: DataFrame,
    text_col: str = "text",
    max_features: int = settings.MAX_FEATURES,
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    stopwords: Iterable[str] | None = None,
) -> DataFrame:
    """``vocabulary`` of the terms of texts, without making the terms.

    Only the words leave the JVM. Runs of them are counted as runs of numbers, and only the
    distinct ones of a batch that may get in become text.
    """
    importable_by_workers(frame.sparkSession)
    words = frame.select(F.expr(_words_sql(text_col)).alias("words"))
    stop = stopword_list("english") if stopwords is None else list(stopwords)
    sizes = range(ngram_range[0], ngram_range[1] + 1)

    def sketch(buckets: int) -> DataFrame:
        work = partial(_sketch_of_words, sizes=sizes, stop=stop, buckets=buckets)
        return words.mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))

    def counts(chosen: DataFrame | None, buckets: int) -> DataFrame:
        bits = None if chosen is None else _bitmap(chosen, buckets)
        work = partial(_counts_of_words, sizes=sizes, stop=stop, buckets=buckets, bits=bits)
        combined = words.mapInArrow(work, "term string, tf bigint, df bigint")
        return combined.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))

    return _by_sketch(sketch, counts, max_features)


@dataclass(frozen=True)
class _Words:
    """The words of a batch of texts but for stop words: ``word`` is a place in ``distinct``."""

    distinct: pa.Array
    word: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, lists: pa.ListArray, stop: Sequence[str]) -> _Words:
        coded = lists.flatten().dictionary_encode()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        common = pc.is_in(coded.dictionary, value_set=pa.array(stop, coded.dictionary.type))
        left = ~common.to_numpy(zero_copy_only=False)[word]
        text = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        return cls(coded.dictionary, word[left], text[left])

    def runs(self, n: int) -> np.ndarray:
        """Where ``n`` words of one text begin."""
        last = max(0, len(self.text) - n + 1)
        return np.flatnonzero(self.text[:last] == self.text[n - 1 :])

    def hashes(self) -> np.ndarray:
        """A number for each word that is the same in every batch."""
        return pd.util.hash_array(self.distinct.to_numpy(zero_copy_only=False), categorize=False)[self.word]

    def numbers(self, runs: np.ndarray, n: int) -> np.ndarray:
        """Equal numbers, from 0 without gaps, for equal runs."""
        number = _numbered(self.word[runs])
        for k in range(1, n):
            number = _numbered(number << 32 | self.word[runs + k])
        return number

    def terms(self, runs: np.ndarray, n: int) -> pa.Array:
        parts = [self.distinct.take(pa.array(self.word[runs + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", self.distinct.type)) if n > 1 else parts[0]


def _numbered(values: np.ndarray) -> np.ndarray:
    return pa.array(values).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _run_buckets(hashes: np.ndarray, runs: np.ndarray, n: int, buckets: int) -> np.ndarray:
    mixed = hashes[runs]
    for k in range(1, n):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[runs + k]
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


class _Known:
    """The terms of a vocabulary, by their number of words."""

    def __init__(self, terms: Sequence[str]):
        places: dict[int, list[int]] = {}
        for place, term in enumerate(terms):
            places.setdefault(term.count(" ") + 1, []).append(place)
        self.by_size = {
            n: (np.array(at), [pa.array(part) for part in zip(*(terms[place].split(" ") for place in at))])
            for n, at in places.items()
        }

    def found(self, words: _Words) -> tuple[np.ndarray, np.ndarray]:
        """Text and place in the vocabulary of each occurrence of a known term."""
        texts, found = [], []
        for n, (places, parts) in self.by_size.items():
            # The same words by their numbers in this batch.
            numbers = [pc.fill_null(pc.index_in(part, value_set=words.distinct), -1).to_numpy(zero_copy_only=False).astype(np.int64) for part in parts]
            here = np.logical_and.reduce([number >= 0 for number in numbers])
            numbers, runs = [number[here] for number in numbers], words.runs(n)
            for k, number in enumerate(numbers):
                may = np.zeros(len(words.distinct), bool)
                may[number] = True
                runs = runs[may[words.word[runs + k]]]
            known, seen = numbers[0], words.word[runs]
            # Beginnings of terms are numbered anew with every word more.
            for k in range(1, n):
                beginnings, known = np.unique(known << 32 | numbers[k], return_inverse=True)
                seen = seen << 32 | words.word[runs + k]
                at = np.minimum(np.searchsorted(beginnings, seen), max(0, len(beginnings) - 1))
                same = beginnings[at] == seen
                runs, seen = runs[same], at[same]
            place = np.zeros(known.max(initial=-1) + 1, np.int64)
            place[known] = places[here]
            texts.append(words.text[runs])
            found.append(place[seen])
        return np.concatenate(texts), np.concatenate(found)


def _vectors_of_words(
    batches: Iterator[pa.Array], terms: Sequence[str], idf: Sequence[float], stop: Sequence[str]
) -> Iterator[pa.Array]:
    """Lists of words to unit-length TF-IDF vectors."""
    known, weight, size = _Known(terms), np.array(idf), len(terms)
    for lists in batches:
        text, place = known.found(_Words.of(lists, stop))
        # Equal numbers stand for equal terms of one text.
        pairs = text * size + place
        pairs.sort()
        firsts = np.flatnonzero(np.diff(pairs, prepend=-1))
        text, place = np.divmod(pairs[firsts], size)
        values = np.diff(firsts, append=len(pairs)) * weight[place]
        # Added one by one in the order of places, as Spark does.
        length = np.sqrt(np.bincount(text, weights=values * values, minlength=len(lists)))
        ends = pa.array(np.searchsorted(text, np.arange(len(lists) + 1)).astype(np.int32))
        yield pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(len(lists), np.int8)),
                pa.array(np.full(len(lists), size, np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(values / length[text])),
            ],
            ["type", "size", "indices", "values"],
        )


def _sketch_of_words(
    batches: Iterator[pa.RecordBatch], sizes: Iterable[int], stop: Sequence[str], buckets: int
) -> Iterator[pa.RecordBatch]:
    """Lists of words to the occurrences of their runs by hash bucket."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        words = _Words.of(batch.column(0), stop)
        hashes = words.hashes()
        for n in sizes:
            total += np.bincount(_run_buckets(hashes, words.runs(n), n, buckets), minlength=buckets)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])


def _counts_of_words(
    batches: Iterator[pa.RecordBatch], sizes: Iterable[int], stop: Sequence[str], buckets: int, bits: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Lists of words to the distinct runs of each batch, with occurrences and number of texts.

    Runs whose bucket is not one of ``bits`` are left out.
    """
    chosen = None if bits is None else np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)
    for batch in batches:
        words = _Words.of(batch.column(0), stop)
        hashes = None if chosen is None else words.hashes()
        for n in sizes:
            runs = words.runs(n)
            if chosen is not None:
                runs = runs[chosen[_run_buckets(hashes, runs, n, buckets)]]
            if not len(runs):
                continue
            number = words.numbers(runs, n)
            tf = np.bincount(number)
            # Equal numbers stand for equal terms of one text.
            pairs = words.text[runs] * len(tf) + number
            pairs.sort()
            df = np.bincount(pairs[np.flatnonzero(np.diff(pairs, prepend=-1))] % len(tf), minlength=len(tf))
            at = np.empty(len(tf), np.int64)
            at[number] = runs
            yield pa.RecordBatch.from_arrays([words.terms(at, n), pa.array(tf), pa.array(df)], ["term", "tf", "df"])


def _by_sketch(
    sketch_of: Callable[[int], DataFrame],
    counts_of: Callable[[DataFrame | None, int], DataFrame],
    max_features: int,
) -> DataFrame:
    """The most frequent terms, from counts by hash bucket and counts of the terms of some buckets.

    Most terms are far too rare to get in, and they are what a count by term would shuffle. So
    occurrences are counted by hash bucket first, into a fixed number of buckets: the count of a
    bucket bounds that of its terms from above. Only terms of buckets that reach a guessed
    frequency are counted themselves. If enough of them reach it, no other term can get in, and
    the guess was right; otherwise it is lowered. The result never depends on it.
    """
    buckets = max(1 << 10, 1 << (16 * max_features - 1).bit_length())
    sketch = written(sketch_of(buckets), "term-sketch")
    wanted = 2 * max_features
    while True:
        # As many numbers as the vocabulary has terms, twice.
        top = sketch.orderBy(F.desc("n")).limit(wanted).agg(F.count(F.lit(1)).alias("found"), F.min("n").alias("n")).first()
        guess = top["n"] if top["found"] == wanted else 1
        counts = written(counts_of(None if guess <= 1 else sketch.where(F.col("n") >= guess), buckets), "term-counts")
        if guess <= 1 or counts.where(F.col("tf") >= guess).count() >= max_features:
            break
        wanted *= 8
    return most_frequent(counts.where(F.col("tf") >= guess), max_features)


def most_frequent(counts: DataFrame, max_features: int) -> DataFrame:
    """The first rows of ``counts`` by falling tf and term.

    Counting the terms per frequency tells how frequent a term must be to get in.
    Only those are sorted, instead of the top of every partition in one task. The
    counts per frequency are added up from the top in ranges, not in one task.
    """
    per_frequency = written(
        counts.groupBy((-F.col("tf")).alias("downwards")).agg(F.count(F.lit(1)).alias("n")),
        "term-frequencies",
    )
    running = totals_before(per_frequency, "downwards", ["n"])
    enough = running.filter(F.col("n_before") + F.col("n") >= max_features)
    lowest = enough.agg(F.coalesce(-F.min("downwards"), F.lit(0)).alias("tf"))
    frequent = counts.filter(F.col("tf") >= lowest.scalar())
    return frequent.orderBy(F.desc("tf"), "term").limit(max_features)


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: terms in order, and their inverse document frequency."""

    terms: list[str]
    idf: list[float]
    ngram_range: tuple[int, int]
    stopwords: list[str]

    def stages(self, text_col: str = "text", output_col: str = "tfidf") -> list[Transformer]:
        """Spark ML stages from text to a unit-length TF-IDF vector; no shuffle.

        They can be stored with a model. ``transform`` gives the same vectors with less work.
        """
        split = term_stage(text_col, "_terms", self.ngram_range, self.stopwords)
        counted = CountVectorizerModel.from_vocabulary(
            self.terms, inputCol="_terms", outputCol="_counts"
        )
        weighted = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weights"
        )
        unit = Normalizer(p=2.0, inputCol="_weights", outputCol=output_col)
        tidy = SQLTransformer(
            statement="SELECT * EXCEPT (_terms, _counts, _weights) FROM __THIS__"
        )
        return [split, counted, weighted, unit, tidy]

    def transform(
        self, frame: DataFrame, text_col: str = "text", output_col: str = "tfidf"
    ) -> DataFrame:
        """The vectors that ``stages`` make, bit by bit, with only the words leaving the JVM."""
        importable_by_workers(frame.sparkSession)
        work = partial(_vectors_of_words, terms=self.terms, idf=self.idf, stop=self.stopwords)

        def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return work(batches)

        vector = F.arrow_udf(vectors, VectorUDT())(F.expr(_words_sql(text_col)))
        # The size is known to what comes next, as it is after the stages.
        size = {"ml_attr": {"num_attrs": len(self.terms)}}
        return frame.withColumn(output_col, vector.alias(output_col, metadata=size))


def fit_tfidf(
    frame: DataFrame,
    text_col: str = "text",
    max_features: int = settings.MAX_FEATURES,
    ngram_range: Sequence[int] = settings.NGRAM_RANGE,
    stopwords: Iterable[str] | None = None,
) -> TfidfModel:
    """Choose the vocabulary and its smoothed weights, ln((1 + n) / (1 + df)) + 1.

    Only the vocabulary itself, at most ``max_features`` rows, comes to the driver.
    """
    stop = stopword_list("english") if stopwords is None else list(stopwords)
    chosen = text_vocabulary(frame, text_col, max_features, ngram_range, stop)
    rows = chosen.select("term", "df").toPandas().sort_values("term")
    if rows.empty:
        raise ValueError("no terms found: the texts are empty or hold only stop words")
    n_texts = frame.count()
    idf = np.log((1.0 + n_texts) / (1.0 + rows["df"].to_numpy(dtype=float))) + 1.0
    return TfidfModel(rows["term"].tolist(), idf.tolist(), tuple(ngram_range), stop)


def vector_entries(
    frame: DataFrame, vector_col: str, model: TfidfModel, keys: Sequence[str]
) -> DataFrame:
    """Non-zero entries of a TF-IDF vector as rows of keys, term and weight."""
    parts = frame.select(*keys, F.unwrap_udt(vector_col).alias("_parts"))
    zipped = F.arrays_zip(F.col("_parts.indices").alias("i"), F.col("_parts.values").alias("w"))
    # One literal, folded to an array when the query is optimised.
    terms = F.split(F.lit("\x01".join(model.terms)), "\x01")
    return parts.select(*keys, F.inline(zipped).alias("i", "w")).select(
        *keys, F.get(terms, F.col("i")).alias("term"), F.col("w").alias("weight")
    )


def entries_by_place(frame: DataFrame, vector_col: str, keys: Sequence[str]) -> DataFrame:
    """Non-zero entries of any vector as rows of keys, place and value."""
    parts = frame.select(*keys, F.unwrap_udt(vector_col).alias("_parts"))
    places = F.coalesce("_parts.indices", F.sequence(F.lit(0), F.size("_parts.values") - 1))
    zipped = F.arrays_zip(places.alias("place"), F.col("_parts.values").alias("value"))
    return parts.select(*keys, F.inline(zipped).alias("place", "value")).filter(F.col("value") != 0)


def naive_bayes_log_theta(
    entries: DataFrame, n_terms: int, alpha: float = settings.NAIVE_BAYES_ALPHA
) -> DataFrame:
    """Smoothed log probability of each term in each class.

    ``entries`` holds label, term and weight of the texts the vocabulary was fitted
    on, so every term occurs at least once.
    """
    by_term = entries.groupBy("term").agg(
        *(F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0.0)).alias(f"class_{c}")
          for c in settings.LABELS)
    )
    sums = by_term.unpivot("term", [f"class_{c}" for c in settings.LABELS], "class", "weight")
    totals = entries.groupBy("label").agg(F.sum("weight").alias("class_total"))
    labelled = sums.withColumn("label", F.substring("class", 7, 1).cast("int"))
    joined = labelled.join(F.broadcast(totals), "label")  # one row per class
    log_theta = F.log(F.col("weight") + alpha) - F.log(F.col("class_total") + alpha * n_terms)
    return joined.select("label", "term", log_theta.alias("log_theta"))


def manual_feature_stage(text_col: str = "text") -> SQLTransformer:
    """The hand-made features as a stage that can be saved with a model."""
    text = f"coalesce({text_col}, '')"
    return SQLTransformer(
        statement=f"""
        SELECT *,
          length({text}) AS length,
          regexp_count({text}, r'{P.URL_MARK}') AS url_count,
          length({text}) - length(replace({text}, '!', '')) AS exclamation_count,
          length({text}) - length(replace({text}, '$', '')) AS dollar_count,
          (length({text}) - length(regexp_replace({text}, r'{P.UPPERCASE_RUN}', '')))
            / (length({text}) + 1) AS uppercase_ratio
        FROM __THIS__"""
    )


def combine_features(tfidf_col: str = "tfidf", output_col: str = "features") -> VectorAssembler:
    """TF-IDF vector and hand-made features side by side."""
    return VectorAssembler(inputCols=[tfidf_col, *MANUAL_FEATURES], outputCol=output_col)
