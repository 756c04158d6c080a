import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from mailsieve.functions.text import stopword_list
from mailsieve.operators import terms
from mailsieve.plans import learning_curve, scoring, table_model, training
from mailsieve.streaming.scoring import (
    read_message_stream,
    read_table_stream,
    score_stream,
    start_scoring,
)

HAM = "minutes agenda budget draft review printer invoice travel library garden lunch"
SPAM = "jackpot casino miracle pills refund voucher crypto selected unlock instant reward"
MEASURES = ["accuracy", "precision_spam", "recall_spam", "f1_spam"]


@pytest.fixture(scope="module")
def dataset(spark):
    rows = [(i, 0, f"{HAM} {i}") for i in range(24)] + [(24 + i, 1, f"{SPAM} {i}") for i in range(24)]
    return spark.createDataFrame(rows, "row_index long, label int, text string")


@pytest.fixture(scope="module")
def trained(dataset):
    return training.train_models(dataset)


def test_training(trained):
    assert set(trained.models) == set(training.MODEL_NAMES)
    assert trained.best_name in training.MODEL_NAMES
    assert (trained.train_rows, trained.test_rows) == (38, 10)
    assert set(trained.predictions.columns) == {"row_index", "label", *training.MODEL_NAMES}
    labels = [r["label"] for r in trained.predictions.collect()]
    assert sorted(labels) == [0] * 5 + [1] * 5
    for row in trained.metrics.collect():
        assert all(0 <= row[name] <= 1 for name in MEASURES)
        assert row["f1_spam"] >= 0.9 and row["recall_spam"] >= 0.9


def test_training_needs_two_classes(dataset):
    with pytest.raises(ValueError, match="both labels"):
        training.train_models(dataset.filter("label = 1"))


def test_sample_size_caps_the_training_rows(dataset):
    result = training.train_models(dataset, sample_size=21, names=["naive_bayes"])
    assert result.train_rows + result.test_rows == 20


def test_raw_text_and_manual_features(dataset):
    result = training.train_models(
        dataset, clean=False, with_manual=True, names=["logistic_regression"]
    )
    assert result.metrics.first()["f1_spam"] >= 0.9
    vocabulary = [s for s in result.best_model.stages if hasattr(s, "vocabulary")][0].vocabulary
    assert result.best_model.stages[-1].numFeatures == len(vocabulary) + 5


def test_saved_models_score_the_same(spark, trained, tmp_path):
    best = training.save_training(trained, str(tmp_path))
    texts = spark.createDataFrame(
        [
            ("Selected for a jackpot: unlock the instant reward, a casino voucher and miracle pills.",),
            ("The draft budget is in the library folder, with the minutes and the travel invoice.",),
        ],
        "text string",
    )
    expected = ["spam", "not spam"]
    for path in [best, *(f"{tmp_path}/models/{n}" for n in training.MODEL_NAMES)]:
        rows = scoring.score_texts(scoring.load_model(path), texts).collect()
        assert [r["prediction"] for r in rows] == expected
        assert all(0 <= r["spam_score"] <= 1 for r in rows)
        assert rows[0]["spam_score"] > 0.5 > rows[1]["spam_score"]
        assert rows[0]["cleaned_text"].startswith("selected jackpot unlock instant reward")
    report = spark.read.json(f"{tmp_path}/train_report").first()
    assert (report["best_model"], report["train_rows"], report["test_rows"]) == (trained.best_name, 38, 10)
    assert report["steps"]["linear_svm"] > 0 and report["passes"]["linear_svm"] > report["steps"]["linear_svm"]
    assert all(report["gradient"][name] < 1e-7 for name in training.MODEL_NAMES)
    metrics = spark.read.option("header", True).csv(f"{tmp_path}/model_metrics")
    assert metrics.count() == 3


def test_solvers_converge(spark):
    """On the given tables too; a solver that is cut off is an error."""
    from mailsieve.plans.registry import training_input

    rows = training_input(spark, "/root/testdata/sf0.01")
    result = training.train_models(rows)
    for name in training.LOSSES:
        assert 0 < result.fits[name].steps < 20 and result.fits[name].passes < 300
        assert result.fits[name].gradient < 1e-7


def test_a_solver_at_its_limit_is_an_error(dataset, monkeypatch):
    monkeypatch.setattr(training.settings, "SOLVER_MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="did not converge"):
        training.train_models(dataset, names=["logistic_regression"])


@pytest.mark.parametrize("frequent", [0, 5, 10_000])
def test_models_as_tables_score_the_same(spark, trained, tmp_path, frequent):
    texts = [f"{HAM} jackpot casino", SPAM, HAM, "jackpot jackpot agenda", "nothing known", "", None, "draft"]
    frame = spark.createDataFrame(list(enumerate(texts)), "row_index int, text string")
    for name in training.LOSSES:
        made = table_model.table_of(trained.models[name], training.settings.NGRAM_RANGE, stopword_list("english"))
        model = table_model.load_table_model(spark, made.save(str(tmp_path / name)))
        expected = scoring.score_texts(trained.models[name], frame, keep=["row_index"])
        found = table_model.score_table(model, frame, "row_index")
        assert sorted(map(tuple, found.collect())) == sorted(tuple(r)[:4] for r in expected.collect())
        parts = table_model.margins(model, frame, "row_index", frequent=frequent).collect()
        whole = {r["row_index"]: r["margin"] for r in table_model.margins(model, frame, "row_index").collect()}
        assert {r["row_index"]: r["margin"] for r in parts} == pytest.approx(whole)
    with pytest.raises(ValueError, match="terms alone"):
        mixed = training.feature_model(frame.where("text is not null"), "text", with_manual=True)
        wide = training.linear_model(spark, "linear_svm", np.ones(3), 0.0)
        table_model.table_of(PipelineModel([*mixed.stages, wide]), (1, 2), [])


def test_missing_model_raises(tmp_path):
    with pytest.raises(Exception):
        scoring.load_model(str(tmp_path / "absent"))


def test_demo_and_files(spark, trained, tmp_path):
    demo = scoring.score_demo(spark, trained.best_model).orderBy("demo_id").collect()
    assert [r["demo_id"] for r in demo] == [1, 2, 3, 4, 5]
    (tmp_path / "a.txt").write_bytes(b"casino jackpot\r\npills \xff reward")
    (tmp_path / "b.txt").write_text("agenda budget invoice")
    rows = scoring.score_files(spark, trained.best_model, str(tmp_path)).collect()
    found = {r["file_path"].rsplit("/", 1)[1]: r for r in rows}
    assert found["a.txt"]["cleaned_text"] == "casino jackpot pills reward"
    assert found["a.txt"]["label"] == 1 and found["b.txt"]["label"] == 0


def test_text_without_known_terms_gets_a_score(spark, trained):
    rows = scoring.score_texts(
        trained.models["naive_bayes"], spark.createDataFrame([("zzz qqq",), ("",)], "text string")
    ).collect()
    assert [r["spam_score"] for r in rows] == [0.5, 0.5]


def test_stream_scores_equal_batch_scores(spark, dataset, trained, tmp_path):
    blank = spark.createDataFrame([(99, None, " \t "), (100, None, None)], dataset.schema)
    folder = str(tmp_path / "in")
    dataset.union(blank).repartition(3).write.parquet(folder)
    stream = read_message_stream(spark, folder, dataset.schema, maxFilesPerTrigger=1)
    scored = score_stream(trained.best_model, stream, keep=["row_index"])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    start_scoring(scored, out, state, available_now=True).awaitTermination()
    batch = scoring.score_texts(trained.best_model, dataset, keep=["row_index"])
    stored = spark.read.parquet(out)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
    # The same through the table's name, be it a folder or a single file.
    for number, name in enumerate(["in", "one"]):
        if name == "one":
            dataset.union(blank).coalesce(1).write.parquet(str(tmp_path / "parts"))
            (part,) = (tmp_path / "parts").glob("*.parquet")
            part.rename(tmp_path / "one")
        arriving = read_table_stream(spark, str(tmp_path), name)
        found, place = str(tmp_path / f"out{number}"), str(tmp_path / f"state{number}")
        scored_again = score_stream(trained.best_model, arriving, keep=["row_index"])
        start_scoring(scored_again, found, place, available_now=True).awaitTermination()
        assert sorted(map(tuple, spark.read.parquet(found).collect())) == sorted(map(tuple, batch.collect()))
    # A restart finds nothing new.
    start_scoring(scored, out, state, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 48


def test_tfidf_by_hand(spark):
    texts = ["spam spam eggs", "eggs and ham", "ham", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    model = terms.fit_tfidf(frame, ngram_range=(1, 2), stopwords=["and"])
    assert model.terms == ["eggs", "eggs ham", "ham", "spam", "spam eggs", "spam spam"]
    entries = terms.vector_entries(model.transform(frame), "tfidf", model, ["doc_id"]).collect()
    found = {(r["doc_id"], r["term"]): r["weight"] for r in entries}

    def idf(df):
        return math.log(5 / (1 + df)) + 1

    raw = {"spam": 2 * idf(1), "eggs": idf(2), "spam spam": idf(1), "spam eggs": idf(1)}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    for term, weight in raw.items():
        assert found[0, term] == pytest.approx(weight / norm)
    assert found[2, "ham"] == pytest.approx(1.0)
    assert not any(doc == 3 for doc, _ in found)


def test_vocabulary_ties_go_to_the_lower_term(spark):
    frame = spark.createDataFrame([("bb aa cc aa",), ("cc bb",)], "text string")
    termed = terms.with_terms(frame, ngram_range=(1, 1), stopwords=[])
    rows = terms.vocabulary(termed, 2).collect()
    assert [(r["term"], r["tf"], r["df"]) for r in rows] == [("aa", 2, 1), ("bb", 2, 2)]


def test_words_and_ngrams(spark):
    frame = spark.createDataFrame([("É_a x 12 don't FOO-bar",), ("",), (None,), ("one",)], "text string")
    rows = terms.with_terms(frame, ngram_range=(1, 3), stopwords=[]).collect()
    assert rows[0]["terms"] == [
        "é_a", "12", "don", "foo", "bar",
        "é_a 12", "12 don", "don foo", "foo bar",
        "é_a 12 don", "12 don foo", "don foo bar",
    ]
    assert [r["terms"] for r in rows[1:]] == [[], [], ["one"]]


def test_terms_equal_those_of_the_library_stages(spark):
    texts = ["The Cat sat on THE mat; 3 cats, été don't Íx", "because of x1 y2", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    stop = stopword_list("english")
    stages = [
        RegexTokenizer(inputCol="text", outputCol="split", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False),
        StopWordsRemover(inputCol="split", outputCol="words", stopWords=stop),
        NGram(n=2, inputCol="words", outputCol="pairs"),
    ]
    expected = [r["words"] + r["pairs"] for r in PipelineModel(stages).transform(frame).collect()]
    assert [r["terms"] for r in terms.with_terms(frame).collect()] == expected


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6, 7, 50])
def test_vocabulary_of_any_size(spark, size):
    texts = ["a1 a1 a1 b1 b1 c1", "c1 d1 e1 f1", "f1 f1"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    termed = terms.with_terms(frame, ngram_range=(1, 1), stopwords=[])
    counts = Counter(" ".join(texts).split())
    expected = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:size]
    assert [(r["term"], r["tf"]) for r in terms.vocabulary(termed, size).collect()] == expected


@pytest.mark.parametrize("size", [3, 40, 400, 5000])
def test_vocabulary_by_sketch_is_exact(spark, size):
    """Many rare terms, ties at the cut, and guesses that are too high at first."""
    draw = np.random.default_rng(size)
    texts = [" ".join(f"w{int(x)}" for x in draw.zipf(1.3, 60) if x < 10**6) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    counts = Counter(w for t in texts for w in t.split())
    docs = Counter(w for t in texts for w in set(t.split()))
    expected = [(w, n, docs[w]) for w, n in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:size]]
    termed = terms.with_terms(frame, ngram_range=(1, 1), stopwords=[])
    assert [tuple(r) for r in terms.vocabulary(termed, size).select("term", "tf", "df").collect()] == expected


def test_rare_terms_are_not_shuffled(spark, monkeypatch):
    stored = {}
    true = terms.written
    monkeypatch.setattr(terms, "written", lambda frame, name: stored.setdefault(name, true(frame, name)))
    texts = [" ".join([f"rare{i}x{j}" for j in range(200)] + [f"common{j}" for j in range(20)]) for i in range(200)]
    termed = terms.with_terms(spark.createDataFrame([(t,) for t in texts], "text string"), ngram_range=(1, 1), stopwords=[])
    assert {r["term"] for r in terms.vocabulary(termed, 20).collect()} == {f"common{j}" for j in range(20)}
    assert stored["term-counts"].count() < 5000 and stored["term-sketch"].count() <= 1024


def test_log_theta_equals_the_fitted_model(spark, dataset):
    model = terms.fit_tfidf(dataset)
    vectors = model.transform(dataset, output_col="features")
    fitted = training.naive_bayes().fit(vectors)
    entries = terms.vector_entries(vectors, "features", model, ["label"])
    theta = terms.naive_bayes_log_theta(entries, len(model.terms))
    mine = np.zeros((2, len(model.terms)))
    for row in theta.collect():
        mine[row["label"], model.terms.index(row["term"])] = row["log_theta"]
    assert np.allclose(mine, fitted.theta.toArray())


def test_manual_stage_equals_columns(spark):
    from mailsieve.functions.features import MANUAL_FEATURES, with_manual_features

    frame = spark.createDataFrame([("Hi! $5 www.x ÉÀ",), (None,), ("",)], "text string")
    staged = terms.manual_feature_stage().transform(frame).select(*MANUAL_FEATURES).collect()
    assert staged == with_manual_features(frame).select(*MANUAL_FEATURES).collect()


def test_learning_curve(dataset):
    curve = learning_curve.learning_curve(dataset, ["naive_bayes"], sizes=(0.6, 1.0), folds=2)
    rows = curve.collect()
    assert len(rows) == 2 * 2 * 2
    for row in rows:
        assert row["f1_spam"] >= 0.9
        if row["part"] == "train":
            assert row["total"] == row["train_rows"]
    full = [r for r in rows if r["size"] == 1.0 and r["part"] == "validation"]
    assert sum(r["total"] for r in full) == 48
    means = learning_curve.curve_means(curve).orderBy("size").collect()
    assert means[0]["train_rows"] < means[1]["train_rows"]


def test_learning_curve_equals_separate_fits(spark):
    """The one pass against a feature model and a classifier of its own for each run."""
    words = [f"w{i}" for i in range(40)]
    draw = np.random.default_rng(3)
    rows = []
    for i in range(90):
        label = int(draw.integers(0, 2))
        mine = words[: 30 + 5 * label] if label else words[5:]
        rows.append((i, label, " ".join(draw.choice(mine, draw.integers(0, 12)))))
    frame = spark.createDataFrame(rows, "row_index long, label int, text string")
    sizes, folds = (1.0, 0.4), 2
    found = {
        (r["model"], r["size"], r["fold"], r["part"]): (r["f1_spam"], r["total"])
        for r in learning_curve.learning_curve(frame, sizes=sizes, folds=folds, max_features=50).collect()
    }
    place = {
        r["row_index"]: (r["fold"], r["place"])
        for r in frame.select(
            "row_index",
            F.floor(learning_curve._hash_share("row_index", "42:fold") * folds).alias("fold"),
            learning_curve._hash_share("row_index", "42:size").alias("place"),
        ).collect()
    }
    for size in sizes:
        for held in range(folds):
            train = [r for r in rows if place[r[0]][0] != held and place[r[0]][1] < size]
            other = [r for r in rows if place[r[0]][0] == held]
            model = training.feature_model(spark.createDataFrame(train, frame.schema), "text", 50)
            n = len([s for s in model.stages if hasattr(s, "vocabulary")][0].vocabulary)
            vectors = model.transform(spark.createDataFrame(train, frame.schema)).select("label", "features")
            fits = training.fit_classifiers(training.MODEL_NAMES, vectors, n)
            for part, members in (("train", train), ("validation", other)):
                scored = model.transform(spark.createDataFrame(members, frame.schema))
                for name, fit in fits.items():
                    pairs = [(r["label"], int(r[name])) for r in fit.model.transform(scored).collect()]
                    tp = sum(a == b == 1 for a, b in pairs)
                    wrong = sum(a != b for a, b in pairs)
                    f1 = round(2 * tp / (2 * tp + wrong), 6) if tp else 0.0
                    assert found[name, size, held, part] == (pytest.approx(f1, abs=2e-6), len(members))
    assert len(found) == 3 * 4 * 2


def test_pipeline_stages_survive_a_reload(spark, dataset, tmp_path):
    features = training.feature_model(dataset, "text", with_manual=True)
    features.write().save(str(tmp_path / "f"))
    again = PipelineModel.load(str(tmp_path / "f"))
    a = features.transform(dataset).select("features").collect()
    assert a == again.transform(dataset).select("features").collect()
    assert a[0]["features"].size == 5 + len(terms.fit_tfidf(dataset).terms)
    assert features.transform(dataset).filter(F.col("length") > 0).count() == 48
