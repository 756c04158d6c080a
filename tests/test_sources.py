import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from mailsieve import session
from mailsieve.operators.position import align_by_position
from mailsieve.plans import full_run
from mailsieve.plans.full_run import require_unique_keys, run_all, with_source_keys
from mailsieve.plans.quality_job import preprocess_texts, run_preprocessing_job, run_quality_job
from mailsieve.schema import MESSAGE_SCHEMA, STANDARD_COLUMNS, text_columns
from mailsieve.sources import readers, sinks, split_csv

MAILS = {
    "easy_ham/0001.aa": b"From x Mon\r\nSubject: Re: one\r\n\ttwo\r\nTo: b@c\r\n\r\nBody line\r\n\r\nmore",
    "hard_ham/0001.aa": "X: y\nsubject:café  \n\n<b>hé</b>".encode(),
    "spam/0002.bb": b"To: me\n\nno subject here\nSubject: not a header",
    "spam_2/0003.cc": b"Subject: only headers",
    "easy_ham_2/0004.dd": b"Subject: bytes \xff\n\nbad \xfe byte",
    "other/0005.ee": b"Subject: z\n\nunknown folder",
}


def test_mail_folders(spark, tmp_path):
    for name, content in MAILS.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True)
        path.write_bytes(content)
    rows = {r["file_key"]: r for r in readers.read_mail_folders(spark, str(tmp_path / "raw")).collect()}
    assert len(rows) == 6
    labels = {k.split("/")[0]: r["label"] for k, r in rows.items()}
    assert labels == {"easy_ham": 0, "hard_ham": 0, "spam": 1, "spam_2": 1, "easy_ham_2": 0, "other": None}
    assert rows["easy_ham/0001.aa"]["subject"] == "Re: one two"
    assert rows["easy_ham/0001.aa"]["text"] == "Body line\r\n\r\nmore"
    assert rows["hard_ham/0001.aa"]["subject"] == "café"
    assert rows["spam/0002.bb"]["subject"] == ""
    assert rows["spam_2/0003.cc"]["text"] == ""
    assert rows["easy_ham_2/0004.dd"]["text"] == "bad � byte"
    assert rows["spam/0002.bb"]["label_name"] == "spam"


TEXTS = ['plain', 'with "quotes" and, commas', "two\nlines\n\n", "back\\slash\\", " padded ", "tab\té\U0001f600", "'"]


def test_csv_round_trip(spark, tmp_path):
    rows = [(i, float(i % 2), t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "row_index long, label double, text string")
    path = sinks.write_csv(frame, str(tmp_path / "csv"))
    back = readers.ingest_csv(spark, path)
    assert sorted((int(r["row_index"]), float(r["label"]), r["text"]) for r in back.collect()) == rows


def test_csv_in_many_splits_equals_one_task(spark, tmp_path):
    """Splits of a few bytes, so that records begin, go on and end in different ones."""
    draw = random.Random(5)
    bits = ["a", "", '"', "\n", "\r\n", ",", "\n\n", "longer text", "é", '""', " x ", "\\"]
    files = []
    for number, ending in enumerate(["\n", "\r\n", "\n"]):
        rows = ["id,text,last"]
        for i in range(30):
            text = "".join(draw.choice(bits) for _ in range(draw.randrange(12 if i % 9 else 200)))
            quoted = '"' + text.replace('"', '""') + '"'
            rows.append(f"{i},{quoted},{draw.choice(['z', chr(34) * 2, ''])}")
        path = tmp_path / f"f{number}.csv"
        path.write_bytes((ending.join(rows) + (ending if number else "")).encode())
        files.append(str(path))
    parsed = {}
    for number, f in enumerate(files):
        with open(f, newline="") as lines:
            parsed[f] = [tuple(x or None for x in row) for row in list(csv.reader(lines))[1:]]
        one_task = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(f).collect()
        # One task turns the line ends inside quotes of the second file to those of Unix.
        assert number == 1 or [tuple(r) for r in one_task] == parsed[f]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("101b", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            for f in files:
                found = readers.ingest_csv(spark, f)
                rows = sorted(found.collect(), key=lambda r: r["row_index"])
                assert [r["row_index"] for r in rows] == list(range(30))
                assert [tuple(r)[:3] for r in rows] == parsed[f], (f, size)
            every = readers.ingest_csv(spark, str(tmp_path)).collect()
            assert sorted(r["row_index"] for r in every) == list(range(90))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "101b")
        lines = split_csv._lines(spark, files[0])
        assert lines.select("start").distinct().count() > 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_csv_header_is_checked(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        readers.read_csv(spark, str(path), text_columns(["a", "c"]))
    (tmp_path / "none.csv").write_text("a,b\n")
    assert readers.ingest_csv(spark, str(tmp_path / "none.csv")).count() == 0


def test_alignment_by_position(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("truth"), F.col("id").alias("guess"))
    for name, parts in (("truth", 7), ("guess", 3)):
        rows.repartitionByRange(parts, name).sortWithinPartitions(name).select(name).write.parquet(str(tmp_path / name))
    truth, guess = (spark.read.parquet(str(tmp_path / n)) for n in ("truth", "guess"))
    aligned = align_by_position(truth, guess).collect()
    assert sorted(map(tuple, aligned)) == [(i, i, i) for i in range(1000)]
    with pytest.raises(ValueError, match="1000 and 999 rows"):
        rows.where("guess < 999").select("guess").write.parquet(str(tmp_path / "short"))
        align_by_position(truth, spark.read.parquet(str(tmp_path / "short")))
    with pytest.raises(ValueError, match="same name"):
        align_by_position(truth, truth)
    # Many files and small splits, whose order in a task is not that of the table.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        assert all(tuple(r) == (r[0],) * 3 for r in align_by_position(truth, guess).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_row_key_follows_the_file(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("label,text\n0,first\n1,\"second\nline\"\n0,third\n")
    back = readers.ingest_csv(spark, str(path)).orderBy("row_index").collect()
    assert [(r["row_index"], r["text"]) for r in back] == [(0, "first"), (1, "second\nline"), (2, "third")]


def test_csv_with_schema(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("source,file_name,label,label_name,subject,text\ns,f,1,spam,hi,body\n")
    row = readers.read_csv(spark, str(path), text_columns(STANDARD_COLUMNS)).first()
    assert (row["label"], row["text"]) == ("1", "body")
    single = readers.read_csv(spark, str(path), text_columns(STANDARD_COLUMNS), multi_line=False)
    assert single.first() == row


def test_three_class_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(i, i, f"t{i}") for i in range(4)], "id long, label int, text string").write.parquet(path)
    out = readers.read_three_class(spark, path, "big", "id").orderBy("id").collect()
    assert [r["label"] for r in out] == [0, 1, 1, None]
    assert {r["source"] for r in out} == {"big"}


def test_fallback_path(spark, tmp_path):
    second = str(tmp_path / "b")
    spark.range(3).write.parquet(second)
    assert readers.read_first_existing(spark, [str(tmp_path / "a"), second]).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_first_existing(spark, [str(tmp_path / "a")])


def test_training_rows(spark):
    frame = spark.createDataFrame([("1", None), ("0.0", "x"), ("2", "y"), (None, "z"), ("q", "w")], "label string, text string")
    assert sorted(map(tuple, readers.training_rows(frame).collect())) == [(0, "x"), (1, "")]
    with pytest.raises(ValueError):
        readers.training_rows(frame.drop("label"))


def test_json_report(spark, tmp_path):
    report = spark.createDataFrame([({"0": 3}, "é")], "counts map<string,long>, note string")
    path = sinks.write_json(report, str(tmp_path / "r"))
    assert spark.read.schema(report.schema).json(path).first() == report.first()


def make_messages(spark):
    rows = [(i, i % 2, f"message number {i % 40} with enough words in it", "s%d" % (i % 3)) for i in range(90)]
    rows += [(100, 0, "short", "s0"), (101, 5, "a label that nobody has ever heard of", "s1"), (102, 1, "", "s2")]
    return spark.createDataFrame(rows, "row_index long, label int, text string, source string")


def test_quality_job(spark, tmp_path):
    result = run_quality_job(make_messages(spark), str(tmp_path / "out"), "in", shuffle_rows=True)
    summary = result.summary.first()
    assert summary["input_rows"] == 93
    assert summary["clean_label_counts"] == {"0": 20, "1": 20}
    assert summary["removed_rows"] == 53
    assert summary["filtered_rows"] == 53
    assert summary["issue_counts"] == {
        "duplicate_label_text": 50, "empty_text": 1, "invalid_label": 1, "short_text": 2,
    }
    assert summary["input_path"] == "in"
    assert result.clean.count() == 40
    assert result.issues.count() == 54
    assert set(result.clean.columns) == set(MESSAGE_SCHEMA.names)


def test_preprocessing_job(spark, tmp_path):
    frame = spark.createDataFrame([("a", "Hello <b>World</b>")] * 2 + [("b", None)], "k string, Body_text string")
    stored = run_preprocessing_job(frame, str(tmp_path), "in")
    assert [r["clean_text"] for r in stored.collect()] == ["hello world"]
    metadata = spark.read.json(str(tmp_path / "metadata")).first()
    assert (metadata["n_rows_input"], metadata["n_rows_output"], metadata["text_column"]) == (1, 1, "Body_text")


def test_minimum_clean_length(spark):
    frame = spark.createDataFrame([("the of and",), ("longer than four",)], "text string")
    assert preprocess_texts(frame, min_text_length=4).count() == 1
    with pytest.raises(ValueError):
        preprocess_texts(frame, "absent")


def test_full_run_with_training(spark, tmp_path):
    ham = spark.range(30).select(
        F.col("id").alias("row_index"), F.lit(0).alias("label"), F.lit("one").alias("source"),
        F.concat(F.lit("meeting agenda project report "), "id").alias("text"))
    spam = spark.range(100, 140).select(
        F.col("id").alias("row_index"), F.lit("1").alias("label"), F.lit("two").alias("source"),
        F.concat(F.lit("free prize money lottery click "), "id").alias("text"))
    result = run_all([ham, spam], str(tmp_path), train_model=True)
    assert result.quality.clean.groupBy("label").count().count() == 2
    assert result.quality.clean.count() == 60
    assert result.training.metrics.first()["f1_spam"] == 1.0
    assert (tmp_path / "training" / "models" / "spam_classifier").exists()
    assert spark.read.parquet(str(tmp_path / "labelled")).count() == 70
    assert spark.read.parquet(str(tmp_path / "balanced")).count() == 60
    # Each source here has one class only, which is then the smallest.
    sizes = [spark.read.parquet(str(tmp_path / "balanced_sources" / n)).count() for n in "01"]
    assert sizes == [30, 40]
    report = spark.read.json(str(tmp_path / "source_report")).collect()
    assert {(r["source"], r["label"]): r["n"] for r in report}["all", "all"] == 70


def test_two_csv_files_with_the_same_keys(spark, tmp_path):
    """Keys from 0 in both, copies within and across the files, in another order."""
    first = ["the garden club meets at noon", "cheap pills ship today only", "the garden club meets at noon"]
    second = ["cheap pills ship today only", "a note about the new printer", "win a cruise by phone now"]
    labels = ([0, 1, 0], [1, 0, 1])
    frames = []
    for name, texts, values in (("a", first, labels[0]), ("b", second, labels[1])):
        path = tmp_path / f"{name}.csv"
        lines = [f'{value},"{text}",{name}' for value, text in zip(values, texts, strict=True)]
        path.write_text("\n".join(["label,text,source", *lines]) + "\n")
        frames.append(readers.ingest_csv(spark, str(path)))
    result = run_all(frames, str(tmp_path / "out"))
    # Three rows of each class remain before cleaning: of both copies the first stays.
    clean = sorted((r["row_index"]["source_no"], r["row_index"]["key"], r["text"]) for r in result.quality.clean.collect())
    assert clean == [(0, 0, first[0]), (0, 1, first[1]), (1, 1, second[1]), (1, 2, second[2])]
    issues = sorted((r["issue"], tuple(r["row_index"])) for r in result.quality.issues.collect())
    assert issues == [("duplicate_label_text", (0, 2)), ("duplicate_label_text", (1, 0))]


def test_keys_must_be_unique_within_a_source(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "row_index long, label int, text string")
    with pytest.raises(ValueError, match="not unique"):
        run_all([frame], str(tmp_path))
    mixed = with_source_keys([frame, frame.withColumn("row_index", F.col("text"))])
    assert [m.schema["row_index"].dataType["key"].dataType.simpleString() for m in mixed] == ["string"] * 2
    with pytest.raises(ValueError, match="missing"):
        require_unique_keys(frame.limit(1).withColumn("row_index", F.lit(None).cast("long")))


def test_a_folder_per_source_gets_few_files(spark, tmp_path):
    rows = spark.range(600, numPartitions=8).select("id", (F.col("id") % 3).cast("string").alias("source"))
    path = sinks.write_table(rows, str(tmp_path / "t"), partition_by="source")
    files = [f.rsplit("/", 2)[1] for f in spark.read.parquet(path).inputFiles()]
    assert sorted(files) == ["source=0", "source=1", "source=2"]
    assert spark.read.parquet(path).count() == 600


def test_scratch_tables_are_removed(spark):
    from pathlib import Path

    session.written(spark.range(3), "a-table")
    folder = Path(session.run_folder(spark))
    assert list(folder.iterdir())
    session.remove_scratch(spark)
    assert not folder.exists()


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


class FakeSession:
    """A session without the folder setting."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_only_a_local_session_makes_its_own_folder():
    folder = session.shared_folder(FakeSession("local[2]"))
    assert folder == session.shared_folder(FakeSession("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("spark://host:7077"))



def stored_sources(spark, folder):
    frames = []
    for number, (label, words) in enumerate([(0, "meeting agenda project report"), (1, "free prize money lottery")]):
        rows = spark.range(20, numPartitions=2).select(
            F.col("id").alias("row_index"), F.lit(label).alias("label"), F.lit(f"s{number}").alias("source"),
            F.concat(F.lit(f"{words} number "), "id").alias("text"),
        )
        path = f"{folder}/in{number}"
        if not os.path.exists(path):
            rows.write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_a_second_run_does_only_what_is_new(spark, tmp_path):
    frames, out = stored_sources(spark, tmp_path), str(tmp_path / "out")
    first = run_all(frames, out)
    assert {"labelled/source_no=0", "labelled/source_no=1", "balanced", "quality"} <= set(first.done)
    rows = sorted(map(tuple, first.quality.clean.collect()))
    again = run_all(stored_sources(spark, tmp_path), out)
    assert again.done == [] and sorted(map(tuple, again.quality.clean.collect())) == rows
    assert again.quality.summary.first() == first.quality.summary.first()
    # New rows in one source: the other one is not read again.
    frames[1].selectExpr("row_index + 100 as row_index", "label", "source", "concat(text, ' more') as text").write.mode("append").parquet(str(tmp_path / "in1"))
    third = run_all(stored_sources(spark, tmp_path), out)
    assert "labelled/source_no=1" in third.done and "balanced_sources/1" in third.done and "quality" in third.done
    assert not {"labelled/source_no=0", "balanced_sources/0"} & set(third.done)
    assert spark.read.parquet(f"{out}/labelled").count() == 60
    assert len(run_all(stored_sources(spark, tmp_path), out, force=True).done) == len(first.done)
    # One source less: its rows go.
    fewer = run_all(stored_sources(spark, tmp_path)[:1], out)
    assert spark.read.parquet(f"{out}/labelled").count() == 20 and "quality" in fewer.done


def test_a_broken_run_goes_on_where_it_broke(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    true, calls = full_run.write_json, []

    def broken(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("no space")
        return true(*args)

    monkeypatch.setattr(full_run, "write_json", broken)
    with pytest.raises(OSError, match="no space"):
        run_all(stored_sources(spark, tmp_path), out)
    rest = run_all(stored_sources(spark, tmp_path), out)
    assert rest.done == ["source_report", "quality"]
    assert rest.quality.clean.count() == 40
    assert [p.name for p in (tmp_path / "out").glob("_manifest*")] == ["_manifest.json"]
