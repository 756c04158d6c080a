"""Counts of terms: exact, and made without a row per occurrence."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailsieve.operators import terms

TEXTS = ["red fox red fox red", "", None, "fox", "RED  dog\nred_fox é1é1 dog", "of the of", "x y z", "fox red " * 500]


@pytest.fixture
def termed(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3)
    return terms.with_terms(frame, stopwords=["of", "the"])


def counted_by_hand(termed):
    tf, df = Counter(), Counter()
    for row in termed.select("terms").collect():
        tf.update(row["terms"])
        df.update(set(row["terms"]))
    return {(term, n, df[term]) for term, n in tf.items()}


@pytest.mark.parametrize("batch", [1, 2, 10_000])
def test_counts_do_not_depend_on_batches(spark, termed, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = {tuple(r) for r in terms.term_counts(termed).select("term", "tf", "df").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == counted_by_hand(termed)


def test_bucket_counts_are_those_of_their_terms(termed):
    expected = Counter()
    each = termed.select(F.explode("terms").alias("term")).select(terms._bucket(F.col("term"), 64).alias("bucket"))
    expected.update(r["bucket"] for r in each.collect())
    assert {r["bucket"]: r["n"] for r in terms._bucket_counts(termed, 64).collect()} == dict(expected)


def test_no_counts_of_no_terms(spark):
    none = spark.createDataFrame([(1, "")], "doc_id int, text string")
    assert terms.term_counts(terms.with_terms(none)).collect() == []
    assert terms._bucket_counts(terms.with_terms(none.limit(0)), 64).collect() == []


@pytest.mark.parametrize("counts", [terms.term_counts, lambda frame: terms._bucket_counts(frame, 64)])
def test_counting_makes_no_row_per_occurrence(termed, counts):
    plan = counts(termed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_terms_unknown_to_a_model_are_not_counted(spark, monkeypatch):
    from mailsieve.plans import table_model

    stored = {}
    true = table_model.written
    monkeypatch.setattr(table_model, "written", lambda frame, name: stored.setdefault(name, true(frame, name)))
    texts = [" ".join([f"rare{i}x{j}" for j in range(200)] + ["red", "fox", "red"]) for i in range(20)] + ["", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    known = spark.createDataFrame([("red", 1.0, 3.0, 20), ("red fox", 2.0, -1.0, 9), ("far", 1.0, 9.0, 1)], "term string, idf double, weight double, df int")
    model = table_model.TableModel(known, 0.5)
    found = {r["doc_id"]: r["margin"] for r in table_model.margins(model, frame, "doc_id").collect()}
    expected = (2 * 3.0 - 2.0) / (2**2 + 2**2) ** 0.5 + 0.5
    assert found == {i: pytest.approx(expected if i < 20 else 0.5) for i in range(22)}
    assert stored["counted-texts"].select(F.sum(F.size("counted"))).first()[0] < 1000  # of some 8,000


def test_no_known_term_is_dropped(spark, termed):
    each = termed.select(F.explode("terms").alias("term")).distinct()
    assert terms.only_terms_of(termed, each).select("terms").collect() == termed.select("terms").collect()
    none = terms.only_terms_of(termed, each.limit(0)).select(F.sum(F.size("terms"))).first()[0]
    assert none == 0


@pytest.mark.parametrize("ngram_range", [(1, 1), (1, 2), (2, 3), (1, 4)])
@pytest.mark.parametrize("max_features", [1, 3, 7, 1000])
def test_vocabulary_of_texts_is_that_of_their_terms(spark, ngram_range, max_features):
    frame = spark.createDataFrame([(text,) for text in TEXTS], "text string").repartition(3)
    stop = ["of", "the", "don't"]
    termed = terms.with_terms(frame, ngram_range=ngram_range, stopwords=stop)
    expected = terms.vocabulary(termed, max_features).select("term", "tf", "df").collect()
    found = terms.text_vocabulary(frame, "text", max_features, ngram_range, stop)
    assert found.select("term", "tf", "df").collect() == expected


def test_vocabulary_of_texts_leaves_out_rare_terms_and_no_other(spark):
    texts = [" ".join(["red fox"] * (i % 5 + 1) + [f"rare{i}x{j}" for j in range(300)]) for i in range(40)]
    frame = spark.createDataFrame([(text,) for text in texts], "text string").repartition(4)
    expected = terms.vocabulary(terms.with_terms(frame), 3).select("term", "tf", "df").collect()
    assert terms.text_vocabulary(frame, max_features=3).select("term", "tf", "df").collect() == expected


def test_fitting_makes_no_terms_in_the_engine(spark, monkeypatch):
    plans, true = [], terms.written
    monkeypatch.setattr(terms, "written", lambda frame, name: plans.append(frame._jdf.queryExecution().toString()) or true(frame, name))
    frame = spark.createDataFrame([(text,) for text in TEXTS], "text string")
    assert terms.fit_tfidf(frame, stopwords=["of"]).terms
    assert plans and not any("zip_with" in plan for plan in plans)


def test_no_vocabulary_of_no_words(spark):
    none = spark.createDataFrame([("",), (None,), ("a b",)], "text string")
    assert terms.text_vocabulary(none).collect() == []
    assert terms.text_vocabulary(none.limit(0)).collect() == []


@pytest.mark.parametrize("ngram_range", [(1, 1), (1, 2), (2, 3), (1, 4)])
@pytest.mark.parametrize("max_features", [1, 9, 1000])
def test_vectors_are_those_of_the_stages_bit_by_bit(spark, ngram_range, max_features):
    texts = [*TEXTS, "red " * 7 + "fox dog", "dog fox red dog fox", "nothing known here"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    model = terms.fit_tfidf(frame.where("doc_id <> 10"), "text", max_features, ngram_range, ["of", "the"])
    expected = frame
    for stage in model.stages():
        expected = stage.transform(expected)
    found = model.transform(frame)
    assert found.columns == expected.columns
    assert sorted(found.collect()) == sorted(expected.collect())
    assert found.schema["tfidf"].metadata["ml_attr"]["num_attrs"] == len(model.terms)


def test_vectors_need_no_terms_in_the_engine(spark):
    frame = spark.createDataFrame([(text,) for text in TEXTS], "text string")
    model = terms.fit_tfidf(frame, stopwords=["of"])
    plan = model.transform(frame)._jdf.queryExecution().toString()
    assert "zip_with" not in plan


@pytest.mark.parametrize("with_manual", [False, True])
def test_text_features_are_those_of_their_stages(spark, tmp_path, with_manual):
    from pyspark.ml import PipelineModel

    from mailsieve.plans.training import feature_model

    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3)
    model = feature_model(frame, "text", with_manual=with_manual)
    found = model.transform(frame)
    assert "zip_with" not in found._jdf.queryExecution().toString()
    model.write().save(str(tmp_path / "features"))
    for plain in (PipelineModel(model.stages), PipelineModel.load(str(tmp_path / "features"))):
        expected = plain.transform(frame)
        assert found.columns == expected.columns
        assert sorted(found.collect()) == sorted(expected.collect())


def test_letters_are_taken_out_as_before(spark):
    from mailsieve.functions import text

    texts = [*TEXTS, " The ÀÉ Über-cat's 3 of\n\tİstanbul the", "...", "the", "a--b", "KK ſ x"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    words = ["the", "of", "a"]
    both = frame.select(text.kept_letter_words(F.col("text"), words), text._drop_words(text.letters_only(F.col("text")), words))
    assert all(new == old for new, old in both.collect())
