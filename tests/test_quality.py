import pandas as pd
import pytest
from pyspark.sql import functions as F

from mailsieve.functions import labels as lab
from mailsieve.operators import dedupe, profile, quality
from mailsieve.operators.normalise import normalise_messages, union_sources
from mailsieve.schema import (
    require_columns,
    text_column_by_preference,
    text_column_by_suffix,
)

ROWS = [
    (0, 0.0, "the ferry to the island leaves from pier two"),
    (1, 1.0, "act today and pay nothing for a whole year"),
    (2, 1.0, "act today and pay nothing for a whole year"),
    (3, 2.0, "a third class that the table does not know"),
    (4, 0.0, ""),
    (5, 1.0, "brief"),
]


@pytest.fixture
def rows(spark):
    return normalise_messages(
        spark.createDataFrame(ROWS, "row_index long, label double, text string")
    )


def test_normalise_fills_parses_and_names(spark):
    frame = spark.createDataFrame(
        [
            (0, "1", " a ", "junk"),
            (1, " 1.0\n", None, "junk"),
            (2, "x", "　b\x1c", "kept"),
            (3, None, "c", None),
            (4, "1d", "d", "junk"),
            (5, "2", "e", "phish"),
            (6, "NaN", "f", "odd"),
        ],
        "row_index long, label string, text string, label_name string",
    )
    out = normalise_messages(frame).orderBy("row_index").collect()
    assert [r["label"] for r in out] == [1.0, 1.0, None, None, None, 2.0, None]
    assert [r["text"] for r in out] == ["a", "", "b", "c", "d", "e", "f"]
    assert [r["label_name"] for r in out] == ["spam", "spam", "kept", None, "junk", "phish", "odd"]
    assert {r["source"] for r in out} == {""}


def test_normalise_without_label_or_text(spark):
    out = normalise_messages(spark.range(1).withColumnRenamed("id", "row_index")).first()
    assert out["label"] is None and out["text"] == ""


def test_issues_of_the_small_table(rows):
    found = quality.find_issues(rows).select("issue", "row_index").collect()
    assert sorted(map(tuple, found)) == [
        ("duplicate_label_text", 2),
        ("empty_text", 4),
        ("invalid_label", 3),
        ("short_text", 4),
        ("short_text", 5),
    ]
    counts = {r["issue"]: r["n"] for r in quality.issue_counts(rows).collect()}
    assert counts == {"invalid_label": 1, "empty_text": 1, "short_text": 2, "duplicate_label_text": 1}


def test_clean_keeps_two_rows(rows):
    clean = quality.clean_messages(rows).orderBy("row_index").collect()
    assert [r["row_index"] for r in clean] == [0, 1]
    assert [r["label_name"] for r in clean] == ["ham", "spam"]
    keys = quality.clean_keys(rows).orderBy("row_index").collect()
    assert [tuple(k) for k in keys] == [(0, 0), (1, 1)]


def test_length_limit_is_inclusive(spark):
    frame = spark.createDataFrame(
        [(0, 0.0, "x" * 19), (1, 0.0, "x" * 20), (2, 1.0, "😀" * 20)],
        "row_index long, label double, text string",
    )
    kept = quality.clean_messages(normalise_messages(frame)).collect()
    assert sorted(r["row_index"] for r in kept) == [1, 2]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_first_copy_survives_whatever_the_layout(spark, partitions):
    data = [(i, float(i % 2), f"text {i % 7} repeated over and over") for i in range(200)]
    data += [(1000 + i, None, "no label but the very same text") for i in range(3)]
    frame = spark.createDataFrame(data, "row_index long, label double, text string")
    frame = frame.repartition(partitions)
    pdf = pd.DataFrame(data, columns=["row_index", "label", "text"])
    expected = pdf[~pdf.duplicated(["label", "text"])]["row_index"].tolist()
    assert sorted(r[0] for r in dedupe.keep_first(frame).select("row_index").collect()) == expected
    flagged = dedupe.mark_duplicates(frame).filter(~F.col("is_duplicate"))
    assert sorted(r["row_index"] for r in flagged.collect()) == expected
    later = sorted(set(pdf["row_index"]) - set(expected))
    assert sorted(r[0] for r in dedupe.duplicate_keys(frame).collect()) == later


def test_dedupe_is_idempotent(rows):
    once = quality.clean_messages(rows)
    twice = quality.clean_messages(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_issues_and_clean_rows_of_one_flagged_table(rows):
    flagged = quality.flag_rows(rows)
    given = quality.issues_of(flagged).collect()
    assert sorted(map(tuple, given)) == sorted(map(tuple, quality.find_issues(rows).collect()))
    clean = quality.clean_of(flagged)
    assert clean.columns == rows.columns
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, quality.clean_messages(rows).collect()))


def test_summary(rows):
    clean = quality.clean_messages(rows)
    summary = quality.quality_summary(rows, clean, quality.issue_counts(rows), kept=clean).first()
    assert (summary["input_rows"], summary["clean_rows"], summary["removed_rows"]) == (6, 2, 4)
    assert summary["input_label_counts"] == {"0": 2, "1": 3, "other": 1}
    assert summary["clean_label_counts"] == {"0": 1, "1": 1}
    assert summary["issue_counts"]["short_text"] == 2
    assert summary["required_columns_present"] is True
    assert summary["filtered_rows"] == 4


def test_quality_rules(rows):
    checks = {"text_present": F.col("text") != "", "label_known": lab.is_valid_label(F.col("label"))}
    result = quality.rule_violations(rows, checks).first().asDict()
    assert result == {"rows": 6, "violations_text_present": 1, "violations_label_known": 1}
    with pytest.raises(ValueError, match="label_known"):
        quality.require_quality(rows, checks)
    kept = rows.filter("row_index < 3")
    assert quality.require_quality(kept, checks) is kept


def test_summary_of_a_dirty_label_column(spark):
    frame = spark.createDataFrame(
        [(i, str(i / 7), f"text number {i} is long enough") for i in range(300)] + [(300, "1", "y" * 30)],
        "row_index long, label string, text string",
    )
    rows = normalise_messages(frame)
    clean = quality.clean_messages(rows)
    summary = quality.quality_summary(rows, clean, quality.issue_counts(rows)).first()
    # 0/7 and 7/7 are known labels.
    assert summary["input_label_counts"] == {"0": 1, "1": 2, "other": 298}


def test_label_words(spark):
    words = ["1", " Spam", "TRUE", "malicious", "phish", "Phishing\n"]
    words += ["0", "ham", "not spam", "NOT_SPAM", "false", "normal", "maybe", None]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    lenient = frame.select(lab.label_from_word(F.col("w"), strict=False).alias("l")).collect()
    assert [r["l"] for r in lenient] == [1] * 6 + [0] * 6 + [None, None]
    with pytest.raises(Exception, match="unknown label: maybe"):
        frame.filter("w = 'maybe'").select(lab.label_from_word(F.col("w"))).collect()
    numbers = spark.range(2).select(lab.label_from_word(F.col("id")).alias("l")).collect()
    assert sorted(r["l"] for r in numbers) == [0, 1]


def test_three_classes(spark):
    out = spark.range(4).select(lab.merge_phishing(F.col("id")).alias("l")).collect()
    assert [r["l"] for r in out] == [0, 1, 1, None]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, text string")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(map(tuple, union_sources(a, b).collect())) == [(1, "x"), (2, None)]


def test_column_choice(spark):
    def frame(*names):
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in names))

    assert text_column_by_suffix(frame("id", "Body_Text")) == "Body_Text"
    assert text_column_by_preference(frame("label", "content", "email")) == "email"
    assert text_column_by_preference(frame("label", "body")) == "body"
    with pytest.raises(ValueError):
        text_column_by_suffix(frame("body"))
    with pytest.raises(ValueError, match="text"):
        require_columns(frame("label"), ["label", "text"])


def test_profiles_match_pandas(spark):
    data = [(0, "aaa"), (1, "b" * 10), (0, None), (1, "c" * 37), (None, "d" * 4), (0, "e" * 100)]
    frame = spark.createDataFrame(data, "label int, text string")
    pdf = pd.DataFrame(data, columns=["label", "text"])
    nulls = {r["column_name"]: r["n_null"] for r in profile.null_counts(frame).collect()}
    assert nulls == pdf.isnull().sum().to_dict()
    missing = [tuple(r) for r in profile.missing_ratio(frame).collect()]
    assert missing == [("label", 0.166667), ("text", 0.166667)]
    lengths = pdf["text"].dropna().str.len().describe()
    row = profile.length_describe(frame).first().asDict()
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
        assert row[ours] == pytest.approx(lengths[theirs], abs=1e-6)
    assert (row["count"], row["min"], row["max"]) == (5, 3, 100)


def test_histogram_matches_numpy(spark):
    import numpy as np

    lengths = {0: [5, 7, 7, 20, 55, 104], 1: [3, 3, 3]}
    data = [(label, "x" * n) for label, ns in lengths.items() for n in ns]
    frame = spark.createDataFrame(data, "label int, text string")
    rows = profile.length_histogram(frame).orderBy("label", "bin").collect()
    for label, ns in lengths.items():
        counts, edges = np.histogram(ns, bins=50)
        mine = [r for r in rows if r["label"] == label]
        assert [r["n"] for r in mine] == counts.tolist()
        assert [r["bin_start"] for r in mine] == pytest.approx(edges[:-1].tolist(), abs=1e-6)
        assert mine[-1]["bin_end"] == pytest.approx(edges[-1])
