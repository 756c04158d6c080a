"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve import settings
from mailsieve.functions import features as feat
from mailsieve.functions import labels as lab
from mailsieve.functions import numeric, text
from mailsieve.functions.patterns import SHORT_STOPWORDS
from mailsieve.operators import dedupe, evaluation, profile, quality, sampling, terms
from mailsieve.operators.normalise import normalise_messages, union_sources
from mailsieve.operators.position import align_by_position
from mailsieve.plans import learning_curve as curve
from mailsieve.plans import scoring, table_model, training
from mailsieve.plans.evaluation_job import run_evaluation_job
from mailsieve.plans.full_run import run_all
from mailsieve.plans.quality_job import preprocess_texts, run_preprocessing_job, run_quality_job
from mailsieve.schema import ROW_KEY, text_columns
from mailsieve.session import scratch_path, written
from mailsieve.sources import readers, sinks
from mailsieve.streaming.scoring import read_table_stream, score_stream, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs -----------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the junk label (1 = low quality) where one is known."""
    known = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return documents.join(known, "doc_id", "left").select(
        F.col("doc_id").alias(ROW_KEY),
        "source",
        F.col("doc_id").cast("string").alias("file_name"),
        "label",
        "text",
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return normalise_messages(raw_messages(spark, folder))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_messages(messages(spark, folder))


def kept_keys(rows: DataFrame) -> DataFrame:
    """Label and key of the rows to keep, stored: sampling reads them several times."""
    return written(quality.clean_keys(rows), "kept-keys")


def balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned, balanced messages: duplicates and sample are decided on keys alone."""
    rows = messages(spark, folder)
    keys = sampling.balance_classes(kept_keys(rows)).select(ROW_KEY)
    return quality.with_final_labels(rows.join(keys, ROW_KEY, "left_semi"))


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled messages with three rule-of-thumb predictions."""
    rows = clean(spark, folder).select(ROW_KEY, "label", "text")
    featured = feat.with_manual_features(rows)
    return featured.select(
        ROW_KEY,
        "label",
        F.when(F.col("exclamation_count") >= 3, "spam").otherwise("ham").alias("by_exclamation"),
        F.when(F.col("uppercase_ratio") >= 0.03, "1").otherwise("0").alias("by_uppercase"),
        F.when(F.col("length") < 400, " PHISHING ").otherwise("not_spam").alias("by_length"),
    )


RULES = ["by_exclamation", "by_uppercase", "by_length"]


def long_rules(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.long_predictions(rule_predictions(spark, folder), "label", RULES)


# --- profile ----------------------------------------------------------------


@query
def label_distribution(spark, folder):
    labelled = raw_messages(spark, folder).filter(F.col("label").isNotNull())
    return profile.label_distribution(labelled)


@query
def source_label_report(spark, folder):
    return profile.source_label_report(raw_messages(spark, folder))


@query
def table_shape(spark, folder):
    return profile.table_shape(raw_messages(spark, folder))


@query
def null_counts(spark, folder):
    return profile.null_counts(raw_messages(spark, folder))


@query
def missing_ratio(spark, folder):
    return profile.missing_ratio(raw_messages(spark, folder))


@query
def column_profile(spark, folder):
    return profile.column_profile(raw_messages(spark, folder))


@query
def length_describe(spark, folder):
    return profile.length_describe(table(spark, folder, "documents"))


@query
def length_describe_by_label(spark, folder):
    return profile.length_describe(clean(spark, folder), by="label")


@query
def length_histogram(spark, folder):
    return profile.length_histogram(messages(spark, folder))


@query
def head_rows(spark, folder):
    rows = profile.head_rows(messages(spark, folder), 5, ROW_KEY)
    return rows.withColumn("preview", text.preview(F.col("text"), 80)).drop("text")


# --- schema, labels, sources ------------------------------------------------


@query
def schema_normalised(spark, folder):
    """Labels arrive as text: plain, padded, with decimals, or not a number at all."""
    known = table(spark, folder, "labels")
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    junk = (1 - F.col("quality")).cast("string")
    written_as = (
        F.when(F.col("quality").isNull(), "unknown")
        .when(F.col("toxic") == 1, F.concat(F.lit(" "), junk, F.lit(".0\t")))
        .otherwise(junk)
    )
    frame = documents.join(known, "doc_id", "left").withColumn("label", written_as)
    return normalise_messages(frame, "doc_id")


@query
def binary_label_map(spark, folder):
    known = table(spark, folder, "labels")
    three = F.when(F.col("toxic") == 1, 2).otherwise(1 - F.col("quality"))
    return known.select(
        "doc_id", three.alias("label"), lab.merge_phishing(three).alias("binary_label")
    )


@query
def label_synonyms(spark, folder):
    known = table(spark, folder, "labels")
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    word = (
        F.when(F.col("quality").isNull(), F.col("lang"))
        .when(F.col("quality") == 1, F.when(F.col("toxic") == 1, "PHISHING").otherwise(" Ham\n"))
        .otherwise(F.when(F.col("toxic") == 1, "Malicious").otherwise("True"))
    )
    return documents.join(known, "doc_id", "left").select(
        "doc_id", word.alias("word"), lab.label_from_word(word, strict=False).alias("label")
    )


@query
def merged_sources(spark, folder):
    documents = table(spark, folder, "documents").select("source", "text")
    conversations = table(spark, folder, "conversations").select(
        F.concat(F.lit("chat_"), "role").alias("source"), "text"
    )
    benchmark = table(spark, folder, "benchmark").select("text")
    merged = union_sources(documents, conversations, benchmark)
    source = F.coalesce("source", F.lit("benchmark"))
    return merged.groupBy(source.alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("characters")
    )


@query
def mail_split(spark, folder):
    """Subject (folded over two lines) and body of messages in mail format."""
    documents = table(spark, folder, "documents")
    head = F.concat(
        F.lit("From: someone@example.com\r\nsubject: "),
        F.col("lang"),
        F.lit("\r\n\t"),
        F.col("source"),
        F.lit("\r\nX-Id: "),
        F.col("doc_id"),
    )
    message = F.concat(head, F.lit("\r\n\r\n"), F.col("text"))
    return documents.select(
        "doc_id",
        readers.mail_subject(message).alias("subject"),
        readers.mail_body(message).alias("text"),
    )


@query
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    sinks.write_csv(raw_messages(spark, folder), path)
    schema = text_columns([ROW_KEY, "source", "file_name", "label", "text"])
    back = readers.ingest_csv(spark, path, schema=schema)
    return normalise_messages(back).withColumn(ROW_KEY, F.col(ROW_KEY).cast("long"))


@query
def csv_in_splits(spark, folder):
    """Quoted texts with line ends in files that are read in many splits."""
    path = scratch_path(spark, "csv-splits")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "text")
    # As many files as the table has splits: text takes more room there, so a file has several.
    sinks.write_csv(documents, path)
    back = readers.ingest_csv(spark, path, schema=text_columns(["doc_id", "lang", "text"]))
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(ROW_KEY).alias("n_keys"),
        F.max(F.col("doc_id").cast("long")).alias("last_doc"),
        F.sum(_first_digits(F.coalesce("text", F.lit("")))).alias("checksum"),
    )


def _first_digits(text: Column) -> Column:
    """A number from the first eight digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


@query
def source_partitioned_table(spark, folder):
    path = scratch_path(spark, "by-source")
    rows = messages(spark, folder)
    sinks.write_table(rows.select(ROW_KEY, "source", "text"), path, partition_by="source")
    stored = readers.read_first_existing(spark, [f"{path}-absent", path])
    return stored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.max(ROW_KEY).alias("last_row")
    )


@query
def json_report(spark, folder):
    path = scratch_path(spark, "report")
    report = profile.source_label_report(raw_messages(spark, folder))
    sinks.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


# --- quality ----------------------------------------------------------------


@query
def quality_issues(spark, folder):
    return quality.find_issues(messages(spark, folder))


@query
def quality_issue_counts(spark, folder):
    return quality.issue_counts(messages(spark, folder))


@query
def clean_messages(spark, folder):
    return clean(spark, folder)


@query
def duplicate_flags(spark, folder):
    flagged = dedupe.mark_duplicates(messages(spark, folder))
    return flagged.select(ROW_KEY, "label", "is_duplicate")


@query
def duplicate_row_keys(spark, folder):
    return dedupe.duplicate_keys(messages(spark, folder))


@query
def whole_row_distinct(spark, folder):
    return dedupe.distinct_rows(table(spark, folder, "documents").select("lang", "text"))


def flat_summary(summary: DataFrame) -> DataFrame:
    """The summary's fields and map entries as rows of part, key and count."""
    numbers = ["input_rows", "clean_rows", "removed_rows"]
    maps = ["input_label_counts", "clean_label_counts", "issue_counts"]

    def entries(name: str) -> Column:
        return F.transform(
            F.map_entries(name),
            lambda e: F.struct(
                F.lit(name).alias("part"), e["key"].alias("key"), e["value"].alias("n")
            ),
        )

    single = F.array(
        *(
            F.struct(F.lit(n).alias("part"), F.lit("all").alias("key"), F.col(n).alias("n"))
            for n in numbers
        )
    )
    return summary.select(F.inline(F.concat(single, *map(entries, maps))))


@query
def quality_summary(spark, folder):
    rows = messages(spark, folder)
    balanced_keys = sampling.balance_classes(kept_keys(rows))
    summary = quality.quality_summary(rows, balanced_keys, quality.issue_counts(rows))
    return flat_summary(summary)


@query
def sanity_checks(spark, folder):
    rows = preprocess_texts(messages(spark, folder))
    return quality.rule_violations(
        rows,
        {
            "clean_text_present": F.col("clean_text").isNotNull(),
            "clean_text_filled": F.col("clean_text") != "",
            "label_known": lab.is_valid_label(F.col("label")),
        },
    )


@query
def quality_job(spark, folder):
    result = run_quality_job(raw_messages(spark, folder), scratch_path(spark, "quality-job"))
    return flat_summary(result.summary)


def three_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Documents, chat turns and benchmark items, labelled, with keys that overlap."""
    chats = table(spark, folder, "conversations").select(
        (F.col("conv_id") * 8 + F.col("turn")).alias(ROW_KEY),
        F.concat(F.lit("chat_"), "role").alias("source"),
        F.when(F.col("role") == "user", 0).otherwise(1).alias("label"),
        "text",
    )
    items = table(spark, folder, "benchmark").select(
        F.col("item_id").alias(ROW_KEY),
        F.lit("benchmark").alias("source"),
        (F.col("item_id") % 2).cast("int").alias("label"),
        "text",
    )
    return [raw_messages(spark, folder), chats, items]


@query
def full_run(spark, folder):
    """Three sources to one balanced clean table, as stored."""
    result = run_all(three_sources(spark, folder), scratch_path(spark, "full-run"))
    return result.quality.clean.select(
        f"{ROW_KEY}.source_no", f"{ROW_KEY}.key", "source", "label", "label_name", "text"
    )


# --- sampling ---------------------------------------------------------------


@query
def balanced_sample(spark, folder):
    return balanced(spark, folder)


@query
def class_sizes(spark, folder):
    """Rows per class beside the smallest class and the number of classes."""
    keys = kept_keys(messages(spark, folder))
    return sampling.class_sizes(keys)


@query
def capped_sample(spark, folder):
    return sampling.capped_sample(kept_keys(messages(spark, folder)), 60)


@query
def stratified_split(spark, folder):
    return sampling.stratified_split(kept_keys(messages(spark, folder)))


@query
def random_split(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return sampling.random_split(documents, row_key="doc_id")


@query
def seeded_shuffle(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    ordered = sampling.shuffled(documents, "doc_id")
    return ordered.withColumn("order_hash", sampling.seeded_hash(F.col("doc_id"), settings.SEED))


# --- text -------------------------------------------------------------------


@query
def pages_without_markup(spark, folder):
    pages = table(spark, folder, "pages")
    return text.with_plain_text(pages, "html", "text").select("page_id", "text")


@query
def entity_tokens(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return text.with_entity_tokens(documents, "text", "text")


@query
def entity_tokens_pages(spark, folder):
    """URLs stand next to markup here, so they run on to the next blank."""
    pages = table(spark, folder, "pages")
    both = pages.select("page_id", F.concat_ws(" ", "url", "html").alias("text"))
    return text.with_entity_tokens(both, "text", "text")


@query
def letters_only(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", text.letters_only(F.col("text")).alias("text"))


@query
def stopwords_removed(spark, folder):
    documents = table(spark, folder, "documents")
    words = text.stopword_list("short", extra=["Que", "AUX"])
    return documents.select("doc_id", text.without_stopwords(F.col("text"), words).alias("text"))


@query
def french_stopwords_removed(spark, folder):
    documents = table(spark, folder, "documents").filter("lang = 'fr'")
    words = text.stopword_list("french")
    return documents.select("doc_id", text.without_stopwords(F.col("text"), words).alias("text"))


@query
def clean_text_documents(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return preprocess_texts(documents).drop("text")


@query
def clean_text_pages(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "html")
    return preprocess_texts(pages, "html").drop("html")


@query
def clean_text_min_length(spark, folder):
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return preprocess_texts(chats, min_text_length=100).drop("text")


@query
def preprocessing_job(spark, folder):
    documents = table(spark, folder, "documents").select("lang", "text")
    stored = run_preprocessing_job(documents, scratch_path(spark, "preprocessing"))
    return stored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("clean_text")).alias("characters")
    )


@query
def manual_features(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return feat.with_manual_features(documents).drop("text")


@query
def manual_features_pages(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.concat("url", "html").alias("text"))
    return feat.with_manual_features(pages).drop("text")


# --- terms ------------------------------------------------------------------


def tfidf_input(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


@query
def vocabulary_topk(spark, folder):
    termed = terms.with_terms(tfidf_input(spark, folder), stopwords=SHORT_STOPWORDS)
    return terms.vocabulary(termed, settings.MAX_FEATURES)


@query
def term_statistics(spark, folder):
    termed = terms.with_terms(
        tfidf_input(spark, folder), ngram_range=(1, 1), stopwords=SHORT_STOPWORDS
    )
    return terms.term_counts(termed)


@query
def tfidf_weights(spark, folder):
    documents = tfidf_input(spark, folder)
    model = terms.fit_tfidf(documents, max_features=settings.MAX_FEATURES, stopwords=SHORT_STOPWORDS)
    vectors = model.transform(documents).select("doc_id", "tfidf")
    entries = terms.vector_entries(vectors, "tfidf", model, ["doc_id"])
    return entries.withColumn("weight", F.round("weight", 6))


@query
def nb_log_theta(spark, folder):
    rows = balanced(spark, folder).select(ROW_KEY, "label", "text")
    rows = written(rows, "theta-rows")
    model = terms.fit_tfidf(rows, max_features=settings.MAX_FEATURES, stopwords=SHORT_STOPWORDS)
    entries = terms.vector_entries(
        model.transform(rows).select("label", "tfidf"), "tfidf", model, ["label"]
    )
    theta = terms.naive_bayes_log_theta(entries, len(model.terms))
    return theta.withColumn("log_theta", F.round("log_theta", 6))


# --- evaluation -------------------------------------------------------------


@query
def confusion_counts(spark, folder):
    return evaluation.confusion_counts(long_rules(spark, folder))


def rounded(frame: DataFrame) -> DataFrame:
    measures = [name for name, kind in frame.dtypes if kind == "double"]
    return frame.withColumns({name: F.round(name, 6) for name in measures})


@query
def model_metrics(spark, folder):
    return rounded(evaluation.model_metrics(long_rules(spark, folder)))


@query
def lenient_metrics(spark, folder):
    """One rule answers with a word that nobody knows for the longest texts."""
    rows = clean(spark, folder).select("label", "text")
    featured = feat.with_manual_features(rows).select(
        "label",
        F.when(F.col("length") >= 2000, "maybe")
        .when(F.col("exclamation_count") >= 3, "spam")
        .otherwise("ham")
        .alias("by_exclamation"),
        F.when(F.col("length") < 400, "1").otherwise("0").alias("by_length"),
    )
    return rounded(
        evaluation.lenient_metrics(featured, "label", ["by_exclamation", "by_length"])
    )


@query
def metrics_compare(spark, folder):
    predictions = rule_predictions(spark, folder)
    return rounded(evaluation.evaluate_columns(predictions, "label", RULES))


@query
def evaluation_job(spark, folder):
    path, output = scratch_path(spark, "predictions"), scratch_path(spark, "evaluation")
    sinks.write_csv(rule_predictions(spark, folder).drop(ROW_KEY), path)
    return rounded(run_evaluation_job(spark, path, "label", RULES, output))


@query
def best_model(spark, folder):
    metrics = evaluation.model_metrics(long_rules(spark, folder))
    return rounded(evaluation.best_model(metrics))


@query
def quality_gate(spark, folder):
    metrics = evaluation.model_metrics(long_rules(spark, folder))
    return rounded(evaluation.quality_gate(metrics))


@query
def confusion_long(spark, folder):
    return evaluation.confusion_long(evaluation.confusion_counts(long_rules(spark, folder)))


@query
def plain_accuracy(spark, folder):
    rows = rule_predictions(spark, folder).select(
        "label", lab.label_from_word(F.col("by_exclamation")).alias("prediction")
    )
    return rounded(evaluation.plain_accuracy(rows))


#: Length from which ``prediction_alignment`` has a prediction: it shows the gaps on both sides.
PREDICTED_FROM = 500


@query
def prediction_alignment(spark, folder):
    """Labels exist for some documents only; predictions for those with long texts."""
    truth = table(spark, folder, "labels").select("doc_id", "quality")
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    predictions = documents.filter(F.col("n_chars") >= PREDICTED_FROM)
    return evaluation.alignment_gaps(truth, predictions, "doc_id")


@query
def aligned_accuracy(spark, folder):
    truth = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    documents = table(spark, folder, "documents")
    guess = (feat.character_count(F.col("text"), "!") >= 3).cast("int").alias("prediction")
    predictions = documents.select("doc_id", guess)
    joined = evaluation.align_predictions(truth, predictions, "doc_id")
    return rounded(evaluation.plain_accuracy(joined))


@query
def positional_accuracy(spark, folder):
    """Labels and predictions stored in one order without a key, in files cut differently."""
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    guess = (feat.character_count(F.col("text"), "!") >= 3).cast("int").alias("prediction")
    rows = table(spark, folder, "documents").join(labels, "doc_id").select("doc_id", "label", guess)
    tables = []
    for name, parts in (("label", 3), ("prediction", 5)):
        path = scratch_path(spark, f"keyless-{name}")
        rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").select(name).write.parquet(path)
        tables.append(spark.read.parquet(path))
    aligned = align_by_position(*tables)
    return aligned.agg(
        F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"),
        F.round(F.avg((F.col("label") == F.col("prediction")).cast("int")), 6).alias("accuracy"),
    )


@query
def roc_auc(spark, folder):
    rows = clean(spark, folder)
    return evaluation.roc_auc(rows.withColumn("score", feat.uppercase_ratio(F.col("text"))))


@query
def sigmoid_score(spark, folder):
    documents = table(spark, folder, "documents")
    margin = 40 * feat.uppercase_ratio(F.col("text")) - 1
    return documents.select(
        "doc_id", numeric.round_half_even(numeric.sigmoid(margin)).alias("spam_score")
    )


# --- models -----------------------------------------------------------------


def naive_bayes_model(spark, folder) -> PipelineModel:
    """Naive Bayes on the cleaned texts of the balanced messages."""
    rows = balanced(spark, folder).select("label", "text")
    rows = written(text.with_clean_text(rows, "text", "text"), "model-rows")
    model = terms.fit_tfidf(rows, max_features=settings.MAX_FEATURES, stopwords=[])
    features = training.TextFeatures(model, "text", "features")
    vectors = features.transform(rows).select("label", "features")
    fitted = training.naive_bayes().fit(vectors)
    return PipelineModel([*features.stages, fitted])


@query
def batch_scores(spark, folder):
    model = naive_bayes_model(spark, folder)
    documents = table(spark, folder, "documents")
    return scoring.score_texts(model, documents, keep=["doc_id"])


@query
def stream_scores(spark, folder):
    path = scratch_path(spark, "naive-bayes")
    naive_bayes_model(spark, folder).write().save(path)
    model = scoring.load_model(path)
    arriving = read_table_stream(spark, folder, "documents.parquet")
    scored = score_stream(model, arriving, keep=["doc_id"])
    output = scratch_path(spark, "stream-scores")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    start_scoring(scored, output, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(scored.schema).parquet(output)


@query
def margin_scores(spark, folder):
    """All documents under a linear model with fixed weights, stored as a table and read back."""
    documents = tfidf_input(spark, folder)
    vocabulary = terms.vocabulary(terms.with_terms(documents, stopwords=SHORT_STOPWORDS))
    n = documents.count()
    idf = F.log((1.0 + n) / (1.0 + F.col("df").cast("double"))) + 1.0
    weight = 8.0 * (_first_digits(F.col("term")) / float(1 << 32) - 0.5)
    made = table_model.TableModel(
        vocabulary.select("term", idf.alias("idf"), weight.alias("weight"), "df"), -0.25, stopwords=tuple(SHORT_STOPWORDS)
    )
    model = table_model.load_table_model(spark, made.save(scratch_path(spark, "table-model")))
    return table_model.score_table(model, documents, "doc_id", clean=False)


def training_input(spark, folder) -> DataFrame:
    return written(balanced(spark, folder), "training-input")


@query
def best_model_scores(spark, folder):
    """All documents scored by the best of three trained models."""
    best = training.train_models(training_input(spark, folder)).best_model
    return scoring.score_texts(best, table(spark, folder, "documents"), keep=["doc_id"])


@query
def train_compare(spark, folder):
    """Metrics and split sizes of the three models."""
    result = training.train_models(training_input(spark, folder))
    return rounded(result.metrics).withColumns(
        {"train_rows": F.lit(result.train_rows), "test_rows": F.lit(result.test_rows)}
    )


@query
def train_sizes(spark, folder):
    """Split sizes, and test rows per class that each of the three models predicted."""
    result = training.train_models(training_input(spark, folder))
    return result.metrics.select(
        "model",
        F.lit(result.train_rows).cast("long").alias("train_rows"),
        F.lit(result.test_rows).cast("long").alias("test_rows"),
        (F.col("tn") + F.col("fp")).alias("test_ham"),
        (F.col("fn") + F.col("tp")).alias("test_spam"),
    )


@query
def train_naive_bayes(spark, folder):
    """The naive Bayes part of training: its metrics on the test part."""
    result = training.train_models(training_input(spark, folder), names=["naive_bayes"])
    return rounded(result.metrics)


@query
def combined_features(spark, folder):
    """Unit-length TF-IDF weights beside the five hand-made features, as entries by place."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = training.feature_model(documents, "text", with_manual=True)
    entries = terms.entries_by_place(model.transform(documents), "features", ["doc_id"])
    return entries.withColumn("value", F.round("value", 6))


@query
def train_with_manual_features(spark, folder):
    """Raw text with the hand-made features beside it. Naive Bayes is closed form; a solver
    needs thousands of steps on features of such different sizes."""
    result = training.train_models(
        training_input(spark, folder), clean=False, with_manual=True, names=["naive_bayes"]
    )
    return rounded(result.metrics)


@query
def learning_curve(spark, folder):
    """Naive Bayes, at the default sizes and folds."""
    return curve.learning_curve(training_input(spark, folder), names=["naive_bayes"])


@query
def learning_curve_solvers(spark, folder):
    """The two iterative models, at the default sizes and folds."""
    return curve.learning_curve(
        training_input(spark, folder), names=["logistic_regression", "linear_svm"]
    )
