"""What the optimiser makes of the operators: the properties that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from mailsieve.functions.features import with_manual_features
from mailsieve.functions.text import with_clean_text
from mailsieve.operators import dedupe, profile, quality, sampling, terms
from mailsieve.operators.normalise import normalise_messages
from mailsieve.plans import scoring
from mailsieve.plans.training import feature_model
from mailsieve.sources.readers import training_rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "messages")
    spark.range(400).select(
        F.col("id").alias("row_index"),
        (F.col("id") % 3 % 2).cast("int").alias("label"),
        F.lit("s").alias("source"),
        F.concat(F.lit("some text that is long enough "), "id").alias("text"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def physical(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def planned(frame):
    """The plan before it runs, subqueries included."""
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


def test_row_functions_need_no_shuffle_and_no_python(stored):
    for frame in (with_clean_text(stored), with_manual_features(stored)):
        plan = physical(frame)
        assert "Exchange" not in plan and "Python" not in plan


def test_scoring_needs_no_shuffle(spark, stored):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import NaiveBayes

    features = feature_model(stored, "text", 100)
    fitted = NaiveBayes().fit(features.transform(stored))
    model = PipelineModel([*features.stages, fitted])
    plan = physical(scoring.score_texts(model, stored, keep=["row_index"]))
    assert "Exchange" not in plan and "Python" not in plan
    assert read_columns(plan) == [{"row_index", "text"}]


def test_label_filter_reaches_the_scan(stored):
    for frame in (training_rows(stored), quality.usable_rows(normalise_messages(stored))):
        plan = physical(frame)
        assert re.search(r"PushedFilters: \[[^\]]*In\(label, \[0,1\]\)", plan), plan


def test_profiles_read_only_their_columns(stored):
    assert read_columns(physical(profile.length_describe(stored))) == [{"text"}]
    assert read_columns(physical(profile.label_distribution(stored))) == [{"label"}]


def test_issue_counts_join_nothing(stored):
    plan = physical(quality.issue_counts(normalise_messages(stored)))
    assert "Join" not in plan
    assert len(read_columns(plan)) == 1


def test_duplicate_keys_shuffle_no_text(stored):
    plan = physical(dedupe.duplicate_keys(stored))
    for line in plan.splitlines():
        if "SortMergeJoin" in line or "ShuffledHashJoin" in line or "BroadcastHashJoin" in line:
            assert "text" not in line


def test_full_rows_are_joined_once(spark, stored, tmp_path):
    """With the keys of later copies; the rest of the quality job joins no texts."""
    for frame in (quality.clean_messages(normalise_messages(stored)), quality.find_issues(normalise_messages(stored))):
        joins = [line for line in planned(frame).splitlines() if re.search(r"Join", line)]
        assert len(joins) == 2, joins  # among narrow records, and with the rows
    flagged = quality.flag_rows(normalise_messages(stored))
    path = str(tmp_path / "flagged")
    flagged.write.parquet(path)
    again = spark.read.parquet(path)
    for frame in (quality.issues_of(again), quality.clean_of(again)):
        assert "Join" not in planned(frame) and "Exchange" not in planned(frame)


def test_texts_are_not_dealt_out_again(spark):
    from mailsieve.plans.registry import QUERIES

    for name in ("quality_issues", "clean_messages", "clean_text_documents"):
        assert "RoundRobin" not in planned(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_lengths_are_counted_before_one_task_sees_them(stored):
    plan = planned(profile.length_describe(stored))
    assert re.search(r"hashpartitioning\(length", plan), plan


def test_sampling_reads_texts_once(stored):
    plan = planned(sampling.balance_classes(stored))
    with_text = [columns for columns in read_columns(plan) if "text" in columns]
    assert len(with_text) == 1


def test_vocabulary_counts_are_made_once(stored):
    plan = planned(terms.vocabulary(terms.with_terms(stored), 50))
    # What is left reads the stored counts; the running totals are cut in ranges.
    assert "Generate" not in plan.replace("_bounds", "")
    assert "SinglePartition" not in plan or "_range" in plan


def test_no_cross_joins(stored):
    frames = [
        sampling.balance_classes(stored),
        sampling.stratified_split(stored),
        sampling.random_split(stored),
        profile.length_histogram(stored),
        quality.find_issues(normalise_messages(stored)),
    ]
    for frame in frames:
        plan = planned(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
