"""The registered queries in plain SQL, for a check by another engine.

White space, word and upper-case classes are written with the same code points as
in the Spark expressions.
"""

from __future__ import annotations

import glob
import os
import zipfile
from functools import cache

import pyspark

from mailsieve import settings
from mailsieve.functions.patterns import SHORT_STOPWORDS, SPACE_CLASS, WHITESPACE

SEED = settings.SEED
UPPER = (
    r"[\p{Lu}\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{1f130}-\x{1f149}"
    r"\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}]"
)


def strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), '{WHITESPACE}')"


def replaced(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', '{flags}')"


def markup(x: str) -> str:
    x = replaced(x, "<script[^>]*>.*?</script>", " ", "gis")
    x = replaced(x, "<style[^>]*>.*?</style>", " ", "gis")
    x = replaced(x, "<[^>]+>", " ")
    for reference, character in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&nbsp;", "\xa0"),
        ("&copy;", "©"),
        ("&middot;", "·"),
    ):
        x = f"replace({x}, '{reference}', '{character}')"
    return replaced(x, "&amp;?", "&")


def entities(x: str) -> str:
    x = replaced(x, rf"https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+", " urltoken ", "gi")
    x = replaced(x, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", " emailtoken ")
    return replaced(x, r"\p{Nd}+", " numbertoken ")


def letters(x: str) -> str:
    return f"trim({replaced(f'lower({x})', '[^a-z]+', ' ')}, ' ')"


@cache
def shipped_stopwords(language: str) -> list[str]:
    """A stop-word list of the installed Spark, read from its jar without a session."""
    folder = os.environ.get("SPARK_HOME", os.path.dirname(pyspark.__file__))
    (jar,) = glob.glob(f"{folder}/jars/spark-mllib_*.jar")
    with zipfile.ZipFile(jar) as files:
        name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
        return files.read(name).decode().split("\n")


def sql_list(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def without_words(tokens: str, words) -> str:
    return (
        f"array_to_string(list_filter({tokens}, "
        f"lambda w: w <> '' AND w NOT IN ({sql_list(words)})), ' ')"
    )


def cleaned(x: str) -> str:
    return without_words(
        f"string_split({letters(entities(markup(x)))}, ' ')", SHORT_STOPWORDS
    )


def hashed(key: str) -> str:
    return f"md5('{SEED}:' || CAST({key} AS VARCHAR))"


RAW = """raw AS (
  SELECT d.doc_id AS row_index, d.source, CAST(d.doc_id AS VARCHAR) AS file_name,
         1 - l.quality AS label, d.text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
NORM = f"""{RAW}, norm AS (
  SELECT row_index, source, file_name, CAST(label AS DOUBLE) AS label,
         CASE label WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' ELSE '' END AS label_name,
         '' AS subject, {strip("text")} AS text
  FROM raw)"""
CLEAN = f"""{NORM}, cleaned AS (
  SELECT row_index, source, file_name, CAST(label AS INTEGER) AS label, label_name, subject, text
  FROM norm
  WHERE label IN (0, 1) AND length(text) >= {settings.MIN_TEXT_LENGTH}
  QUALIFY row_number() OVER (PARTITION BY label, text ORDER BY row_index) = 1)"""
RANKED = f"""{CLEAN}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hashed("row_index")}, row_index) AS rk,
         count(*) OVER (PARTITION BY label) AS n_label, count(*) OVER () AS n_all
  FROM cleaned)"""
BALANCED = f"""{RANKED}, balanced AS (
  SELECT row_index, source, file_name, label, label_name, subject, text
  FROM ranked WHERE rk <= (SELECT min(n_label) FROM ranked))"""
FLAGGED = f"""{NORM}, flagged AS (
  SELECT *, label IS NULL OR label NOT IN (0, 1) AS invalid_label,
         length(text) = 0 AS empty_text, length(text) < {settings.MIN_TEXT_LENGTH} AS short_text,
         row_number() OVER (PARTITION BY label, text ORDER BY row_index) > 1
           AS duplicate_label_text
  FROM norm)"""
ISSUE_NAMES = ["invalid_label", "empty_text", "short_text", "duplicate_label_text"]
ISSUE_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS issue, row_index, source, file_name, label, label_name, text "
    f"FROM flagged WHERE {name}"
    for name in ISSUE_NAMES
)
SUMMARY = f"""
WITH {BALANCED}, flagged AS (
  SELECT *, label IS NULL OR label NOT IN (0, 1) AS invalid_label,
         length(text) = 0 AS empty_text, length(text) < {settings.MIN_TEXT_LENGTH} AS short_text,
         row_number() OVER (PARTITION BY label, text ORDER BY row_index) > 1
           AS duplicate_label_text
  FROM norm), issues AS ({ISSUE_ROWS})
SELECT 'input_rows' AS part, 'all' AS key, (SELECT count(*) FROM norm) AS n
UNION ALL SELECT 'clean_rows', 'all', (SELECT count(*) FROM balanced)
UNION ALL SELECT 'removed_rows', 'all',
  (SELECT count(*) FROM norm) - (SELECT count(*) FROM balanced)
UNION ALL SELECT 'input_label_counts', CAST(CAST(label AS INTEGER) AS VARCHAR), count(*)
  FROM norm WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'clean_label_counts', CAST(label AS VARCHAR), count(*)
  FROM balanced GROUP BY label
UNION ALL SELECT 'issue_counts', issue, count(*) FROM issues GROUP BY issue
"""


def upper_ratio(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{UPPER}')) AS DOUBLE) / (length({x}) + 1)"


def count_char(x: str, character: str) -> str:
    return f"CAST(length({x}) - length(replace({x}, '{character}', '')) AS INTEGER)"


def manual(x: str) -> str:
    return f"""CAST(length({x}) AS INTEGER) AS length,
  CAST(len(regexp_extract_all({x}, 'https?://|www\\.')) AS INTEGER) AS url_count,
  {count_char(x, "!")} AS exclamation_count,
  {count_char(x, "$")} AS dollar_count,
  {upper_ratio(x)} AS uppercase_ratio"""


RULES = f"""{CLEAN}, rules AS (
  SELECT label,
         CASE WHEN {count_char("text", "!")} >= 3 THEN 1 ELSE 0 END AS by_exclamation,
         CASE WHEN {upper_ratio("text")} >= 0.03 THEN 1 ELSE 0 END AS by_uppercase,
         CASE WHEN length(text) < 400 THEN 1 ELSE 0 END AS by_length
  FROM cleaned), predictions AS (
  SELECT 'by_exclamation' AS model, label, by_exclamation AS prediction FROM rules
  UNION ALL SELECT 'by_uppercase', label, by_uppercase FROM rules
  UNION ALL SELECT 'by_length', label, by_length FROM rules), cells AS (
  SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM predictions GROUP BY model)"""


def ratio(numerator: str, denominator: str) -> str:
    return (
        f"CASE WHEN ({denominator}) = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE CAST({numerator} AS DOUBLE) / ({denominator}) END"
    )


METRICS = f"""{RULES}, rates AS (
  SELECT *, tn + fp + fn + tp AS total, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r
  FROM cells), metrics AS (
  SELECT model, round({ratio("tp + tn", "total")}, 6) AS accuracy, round(p, 6) AS precision_spam,
         round(r, 6) AS recall_spam, round({ratio("2 * p * r", "p + r")}, 6) AS f1_spam,
         round({ratio("fp", "fp + tn")}, 6) AS false_positive_rate, tn, fp, fn, tp, total
  FROM rates)"""
RANKING = "f1_spam DESC, recall_spam DESC, precision_spam DESC, model"


def describe(by: str = "") -> str:
    return f"""{by} count(*) AS count, round_even(avg(length(text)), 6) AS mean,
  round_even(stddev_samp(length(text)), 6) AS std, CAST(min(length(text)) AS INTEGER) AS min,
  quantile_cont(CAST(length(text) AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST(length(text) AS DOUBLE), 0.5) AS p50,
  quantile_cont(CAST(length(text) AS DOUBLE), 0.75) AS p75,
  CAST(max(length(text)) AS INTEGER) AS max"""


def term_rows(source: str, key: str, stop, bigrams: bool = True) -> str:
    """CTEs: ``words`` (with position) and ``terms`` of (key, term)."""
    keep = f"WHERE word NOT IN ({sql_list(stop)})" if stop else ""
    pairs = (
        f"""UNION ALL SELECT {key}, word || ' ' || next_word FROM (
    SELECT {key}, word, lead(word) OVER (PARTITION BY {key} ORDER BY pos) AS next_word FROM words)
  WHERE next_word IS NOT NULL"""
        if bigrams
        else ""
    )
    return f"""split AS (
  SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS found
  FROM {source}), words AS (
  SELECT {key}, word, pos FROM (
    SELECT {key}, unnest(found) AS word, generate_subscripts(found, 1) AS pos FROM split)
  {keep}), terms AS (
  SELECT {key}, word AS term FROM words
  {pairs})"""


def weight_rows(source: str, key: str, limit: int) -> str:
    """CTEs: vocabulary and unit-length TF-IDF weights of (key, term)."""
    return f"""counted AS (
  SELECT {key}, term, count(*) AS tf FROM terms GROUP BY {key}, term), vocab AS (
  SELECT term, sum(tf) AS tf, count(*) AS df FROM counted GROUP BY term
  ORDER BY tf DESC, term LIMIT {limit}), weighted AS (
  SELECT {key}, term, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + df))
         + 1.0::DOUBLE) AS w
  FROM (SELECT c.{key}, c.term, CAST(c.tf AS DOUBLE) AS tf, CAST(v.df AS DOUBLE) AS df
        FROM counted c JOIN vocab v ON c.term = v.term)), weights AS (
  SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM weighted)"""


def theta_rows(source: str, key: str) -> str:
    alpha = f"CAST({settings.NAIVE_BAYES_ALPHA} AS DOUBLE)"
    return f"""class_weights AS (
  SELECT b.label, w.term, sum(w.weight) AS s
  FROM weights w JOIN {source} b ON w.{key} = b.{key} GROUP BY b.label, w.term), class_totals AS (
  SELECT label, sum(s) AS total FROM class_weights GROUP BY label), theta AS (
  SELECT t.label, v.term,
         ln(coalesce(c.s, 0) + {alpha}) - ln(t.total + {alpha} * (SELECT count(*) FROM vocab))
           AS log_theta
  FROM vocab v CROSS JOIN class_totals t
  LEFT JOIN class_weights c ON c.term = v.term AND c.label = t.label)"""


MODEL = f"""{BALANCED}, fitted AS (
  SELECT row_index, label, {cleaned("text")} AS text FROM balanced),
{term_rows("fitted", "row_index", [])}, {weight_rows("fitted", "row_index", settings.MAX_FEATURES)},
{theta_rows("fitted", "row_index")}"""
# The two classes are equally frequent, so their priors cancel out.
SCORES = f"""WITH {MODEL}, texts AS (
  SELECT doc_id, text AS original, {cleaned("text")} AS text FROM documents),
{term_rows("texts", "doc_id", []).replace("split", "split2").replace("words", "words2")
 .replace("terms AS", "terms2 AS")}, found_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM terms2 GROUP BY doc_id, term), doc_weights AS (
  SELECT f.doc_id, f.term, f.tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM fitted))
         / (1.0::DOUBLE + CAST(v.df AS DOUBLE))) + 1.0::DOUBLE) AS w
  FROM found_terms f JOIN vocab v ON f.term = v.term), unit AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
  FROM doc_weights), margins AS (
  SELECT u.doc_id, sum(u.weight * CASE t.label WHEN 1 THEN t.log_theta ELSE -t.log_theta END) AS m
  FROM unit u JOIN theta t ON u.term = t.term GROUP BY u.doc_id)
SELECT d.doc_id, CAST(coalesce(m.m, 0) > 0 AS INTEGER) AS label,
       CASE WHEN coalesce(m.m, 0) > 0 THEN 'spam' ELSE 'not spam' END AS prediction,
       round_even(1 / (1 + exp(-coalesce(m.m, 0))), 6) AS spam_score, d.text AS cleaned_text
FROM texts d LEFT JOIN margins m ON d.doc_id = m.doc_id"""

def naive_bayes_runs(rows: str) -> str:
    """CTEs from ``runs`` (run, row_index, label, in_train) and the texts of ``rows`` to
    ``predicted`` (run, row_index, label, in_train, prediction): a vocabulary, weights and a
    naive Bayes model of its own for each run.
    """
    alpha = f"CAST({settings.NAIVE_BAYES_ALPHA} AS DOUBLE)"
    return f"""{term_rows(rows, "row_index", shipped_stopwords("english"))}, counted AS (
  SELECT row_index, term, CAST(count(*) AS DOUBLE) AS tf FROM terms GROUP BY row_index, term), vocab AS (
  SELECT r.run, c.term, CAST(count(*) AS DOUBLE) AS df FROM counted c JOIN runs r ON c.row_index = r.row_index
  WHERE r.in_train GROUP BY r.run, c.term
  QUALIFY row_number() OVER (PARTITION BY r.run ORDER BY sum(c.tf) DESC, c.term) <= {settings.MAX_FEATURES}),
sizes AS (
  SELECT run, count(*) AS n, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0
  FROM runs WHERE in_train GROUP BY run), n_terms AS (
  SELECT run, count(*) AS v FROM vocab GROUP BY run), weighted AS (
  SELECT r.run, r.row_index, c.term, c.tf * (ln((1.0::DOUBLE + s.n) / (1.0::DOUBLE + v.df)) + 1.0::DOUBLE) AS w
  FROM runs r JOIN counted c ON r.row_index = c.row_index JOIN vocab v ON v.run = r.run AND v.term = c.term
  JOIN sizes s ON s.run = r.run), weights AS (
  SELECT run, row_index, term, w / sqrt(sum(w * w) OVER (PARTITION BY run, row_index)) AS weight
  FROM weighted), class_weights AS (
  SELECT w.run, w.term, sum(CASE r.label WHEN 1 THEN weight ELSE 0 END) AS s1,
         sum(CASE r.label WHEN 0 THEN weight ELSE 0 END) AS s0
  FROM weights w JOIN runs r ON w.run = r.run AND w.row_index = r.row_index WHERE r.in_train
  GROUP BY w.run, w.term), class_totals AS (
  SELECT run, sum(s1) AS t1, sum(s0) AS t0 FROM class_weights GROUP BY run), theta AS (
  SELECT c.run, c.term, ln(c.s1 + {alpha}) - ln(t.t1 + {alpha} * n.v)
         - ln(c.s0 + {alpha}) + ln(t.t0 + {alpha} * n.v) AS odds
  FROM class_weights c JOIN class_totals t ON c.run = t.run JOIN n_terms n ON n.run = c.run), margins AS (
  SELECT w.run, w.row_index, sum(w.weight * t.odds) AS margin
  FROM weights w JOIN theta t ON w.run = t.run AND w.term = t.term GROUP BY w.run, w.row_index), predicted AS (
  SELECT r.run, r.row_index, r.label, r.in_train,
         CASE WHEN s.n1 = 0 THEN 0 WHEN s.n0 = 0 THEN 1
              ELSE CAST(coalesce(m.margin, 0) + ln(s.n1 + {alpha}) - ln(s.n0 + {alpha}) > 0 AS INTEGER)
         END AS prediction
  FROM runs r JOIN sizes s ON r.run = s.run LEFT JOIN margins m ON m.run = r.run AND m.row_index = r.row_index)"""


def solver_runs(steps: int = 1500) -> str:
    """CTEs after those of ``naive_bayes_runs``: ``solver_margins`` (run, loss, row_index, label,
    in_train, f) of both linear models of each run.

    The weights are a sum over the training rows, so an accelerated gradient descent needs their
    products only. It has nothing in common with the other solver but the objective. The step comes
    from the largest row sum of the products, which bounds their largest eigenvalue.
    """
    return f"""products AS (
  SELECT a.run, a.row_index, b.row_index AS other, sum(a.weight * b.weight) AS k
  FROM weights a JOIN weights b ON a.run = b.run AND a.term = b.term
  JOIN runs r ON r.run = b.run AND r.row_index = b.row_index AND r.in_train
  GROUP BY ALL), product_rows AS MATERIALIZED (
  SELECT m.run, m.row_index, m.label, m.in_train, list(coalesce(p.k, 0.0::DOUBLE) ORDER BY t.row_index) AS k
  FROM runs m JOIN runs t ON t.run = m.run AND t.in_train
  LEFT JOIN products p ON p.run = m.run AND p.row_index = m.row_index AND p.other = t.row_index
  GROUP BY ALL), problems AS MATERIALIZED (
  SELECT *, (sqrt(bend / flat) - 1) / (sqrt(bend / flat) + 1) AS m FROM (
    SELECT run, kk, y, loss, CASE loss WHEN 'logistic' THEN 1 + big / 4 ELSE 1 + 2 * big END AS bend,
           CASE loss WHEN 'logistic' THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END AS flat
    FROM (SELECT run, list(k ORDER BY row_index) AS kk, list(2.0::DOUBLE * label - 1 ORDER BY row_index) AS y,
                 max(list_sum(k)) + count(*) AS big
          FROM product_rows WHERE in_train GROUP BY run HAVING min(label) < max(label)),
         (SELECT unnest(['logistic', 'squared_hinge']) AS loss))), descent AS (
  SELECT run, loss, 0 AS step, list_transform(y, lambda x: 0.0::DOUBLE) AS a, 0.0::DOUBLE AS b,
         list_transform(y, lambda x: 0.0::DOUBLE) AS a0, 0.0::DOUBLE AS b0
  FROM problems
  UNION ALL
  SELECT run, loss, step + 1, list_transform(list_zip(ya, u), lambda p: p[1] - (p[1] - p[2]) / bend),
         CASE loss WHEN 'logistic' THEN yb + list_sum(u) / bend ELSE yb - (yb - list_sum(u)) / bend END, a, b
  FROM (
    SELECT *, CASE loss WHEN 'logistic' THEN list_transform(list_zip(f, y), lambda p: p[2] / (1 + exp(p[1] * p[2])))
              ELSE list_transform(list_zip(f, y), lambda p: 2 * p[2] * greatest(0, 1 - p[1] * p[2])) END AS u
    FROM (
      SELECT *, list_transform(kk, lambda k: list_dot_product(k, ya) + yb) AS f
      FROM (
        SELECT d.*, q.kk, q.y, q.bend, list_transform(list_zip(d.a, d.a0), lambda p: p[1] + q.m * (p[1] - p[2])) AS ya,
               d.b + q.m * (d.b - d.b0) AS yb
        FROM descent d JOIN problems q ON q.run = d.run AND q.loss = d.loss WHERE d.step < {steps})))),
solved AS MATERIALIZED (SELECT run, loss, a, b FROM descent WHERE step = {steps}), solver_margins AS (
  SELECT p.run, s.loss, p.row_index, p.label, p.in_train, list_dot_product(p.k, s.a) + s.b AS f
  FROM product_rows p JOIN solved s ON s.run = p.run)"""


def cell_counts(keys: str, source: str) -> str:
    return f"""SELECT {keys}, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) AS total
  FROM {source} GROUP BY {keys}"""


LOSS_NAMES = "CASE loss WHEN 'logistic' THEN 'logistic_regression' ELSE 'linear_svm' END"
#: The training split: a fifth of each class of the balanced rows.
SPLIT = f"""{BALANCED}, split_ranked AS (
  SELECT row_index, label, text, row_number() OVER (PARTITION BY label ORDER BY {hashed("row_index")}, row_index) AS rk,
         count(*) OVER (PARTITION BY label) AS n_label, count(*) OVER () AS n_all
  FROM balanced), split_sizes AS (
  SELECT DISTINCT label, n_label, n_all,
         CAST(ceil(CAST({settings.TEST_SHARE} AS DOUBLE) * n_all) AS BIGINT) AS n_test
  FROM split_ranked), split_parts AS (
  SELECT *, n_test * n_label // n_all AS whole, n_test * n_label % n_all AS rest FROM split_sizes),
split_quotas AS (
  SELECT label, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                             <= n_test - sum(whole) OVER () THEN 1 ELSE 0 END AS quota
  FROM split_parts), parted AS (
  SELECT r.row_index, r.label, {cleaned("r.text")} AS text, r.rk <= q.quota AS is_test
  FROM split_ranked r JOIN split_quotas q ON r.label = q.label)"""


def first_digits(text: str) -> str:
    """A number from the first eight digits of a text's MD5."""
    return f"CAST(CAST('0x' || substring(md5({text}), 1, 8) AS UBIGINT) AS DOUBLE)"


def share_of(key: str, name: str) -> str:
    """A number in [0, 1) from the first eight digits of a seeded hash."""
    digits = f"substring(md5('{SEED}:{name}:' || CAST({key} AS VARCHAR)), 1, 8)"
    return f"(CAST(CAST('0x' || {digits} AS UBIGINT) AS DOUBLE) / 4294967296)"


#: Margins of the three models on the split, and their metrics on its test part.
TRAINED = f"""{SPLIT}, runs AS (
  SELECT 0 AS run, row_index, label, NOT is_test AS in_train FROM parted), {naive_bayes_runs("parted")},
{solver_runs()}, tested AS (
  SELECT 'naive_bayes' AS model, label, prediction FROM predicted WHERE NOT in_train
  UNION ALL SELECT {LOSS_NAMES}, label, CAST(f > 0 AS INTEGER) FROM solver_margins WHERE NOT in_train), model_cells AS (
  {cell_counts("model", "tested")}), model_rates AS (
  SELECT *, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r FROM model_cells), trained AS (
  SELECT model, {ratio("tp + tn", "total")} AS accuracy, p AS precision_spam, r AS recall_spam,
         {ratio("2 * p * r", "p + r")} AS f1_spam, {ratio("fp", "fp + tn")} AS false_positive_rate, tn, fp, fn, tp, total
  FROM model_rates)"""
#: All documents under all three models of the split.
BEST_SCORES = f"""WITH RECURSIVE {TRAINED}, texts AS (
  SELECT doc_id, {cleaned("text")} AS text FROM documents),
{term_rows("texts", "doc_id", shipped_stopwords("english")).replace("split", "split2").replace("words", "words2")
 .replace("terms AS", "terms2 AS")}, doc_terms AS (
  SELECT t.doc_id, t.term, count(*) * max(ln((1.0::DOUBLE + s.n) / (1.0::DOUBLE + v.df)) + 1.0::DOUBLE) AS w
  FROM terms2 t JOIN vocab v ON v.term = t.term CROSS JOIN sizes s GROUP BY t.doc_id, t.term), unit AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM doc_terms), term_weights AS (
  SELECT w.term, s.loss, sum(s.a[p.i] * w.weight) AS x FROM weights w
  JOIN (SELECT row_index, row_number() OVER (ORDER BY row_index) AS i FROM runs WHERE in_train) p ON p.row_index = w.row_index
  CROSS JOIN solved s GROUP BY w.term, s.loss
  UNION ALL SELECT term, 'naive_bayes', odds FROM theta), offsets AS (
  SELECT loss, b FROM solved
  UNION ALL SELECT 'naive_bayes', ln(n1 + {settings.NAIVE_BAYES_ALPHA}::DOUBLE) - ln(n0 + {settings.NAIVE_BAYES_ALPHA}::DOUBLE) FROM sizes), chosen AS (
  SELECT model FROM trained ORDER BY f1_spam DESC, recall_spam DESC, precision_spam DESC, model LIMIT 1), used AS (
  SELECT * FROM offsets WHERE CASE loss WHEN 'naive_bayes' THEN loss ELSE {LOSS_NAMES} END = (SELECT model FROM chosen)), doc_margins AS (
  SELECT u.doc_id, sum(u.weight * t.x) AS m FROM unit u JOIN term_weights t ON t.term = u.term
  WHERE t.loss = (SELECT loss FROM used) GROUP BY u.doc_id), all_margins AS (
  SELECT d.doc_id, d.text, coalesce(m.m, 0) + (SELECT b FROM used) AS m FROM texts d LEFT JOIN doc_margins m ON m.doc_id = d.doc_id)
SELECT doc_id, CAST(m > 0 AS INTEGER) AS label, CASE WHEN m > 0 THEN 'spam' ELSE 'not spam' END AS prediction,
       round_even(1 / (1 + exp(-m)), 6) AS spam_score, text AS cleaned_text
FROM all_margins"""


MODELS = ["naive_bayes", "logistic_regression", "linear_svm"]
#: The runs of the learning curve at its default sizes and folds, and its columns.
CURVE = f"""{BALANCED}, placed AS (
  SELECT row_index, label, text, CAST(floor({share_of("row_index", "fold")} * 3) AS INTEGER) AS fold,
         {share_of("row_index", "size")} AS place
  FROM balanced), grid AS (
  SELECT size, held, row_number() OVER () AS run
  FROM (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE]) AS size),
       (SELECT unnest([0, 1, 2]) AS held)), runs AS (
  SELECT g.run, p.row_index, p.label, p.fold <> g.held AS in_train
  FROM grid g, placed p WHERE p.fold = g.held OR p.place < g.size), {naive_bayes_runs("placed")}"""
CURVE_COLUMNS = f"""g.size, g.held AS fold, s.n AS train_rows,
       CASE WHEN r.in_train THEN 'train' ELSE 'validation' END AS part,
       round_even({ratio("2 * p * r", "p + r")}, 6) AS f1_spam, r.total"""
KEYED = "'{' || source_no || ', ' || key || '}'"
FULL_RUN = f"""WITH {NORM}, sources AS (
  SELECT 0 AS source_no, row_index AS key, source, label, text FROM norm
  UNION ALL SELECT 1, conv_id * 8 + turn, 'chat_' || role, CASE role WHEN 'user' THEN 0 ELSE 1 END, {strip("text")}
  FROM conversations
  UNION ALL SELECT 2, item_id, 'benchmark', item_id % 2, {strip("text")} FROM benchmark), first_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || {KEYED}), source_no, key) AS rk,
         count(*) OVER (PARTITION BY label) AS n_label
  FROM sources WHERE label IN (0, 1)), merged AS (
  SELECT * FROM first_ranked WHERE rk <= (SELECT min(n_label) FROM first_ranked)), firsts AS (
  SELECT source_no, key, source, label, text FROM merged
  WHERE length(text) >= {settings.MIN_TEXT_LENGTH}
  QUALIFY row_number() OVER (PARTITION BY label, text ORDER BY source_no, key) = 1), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || {KEYED}), source_no, key) AS rk,
         count(*) OVER (PARTITION BY label) AS n_label
  FROM firsts)
SELECT source_no, key, source, CAST(label AS INTEGER) AS label,
       CASE label WHEN 0 THEN 'ham' ELSE 'spam' END AS label_name, text
FROM ranked WHERE rk <= (SELECT min(n_label) FROM ranked)"""
PROFILED = ["row_index", "source", "file_name", "label", "text"]
PROFILE_TYPES = ["bigint", "string", "string", "int", "string"]

ORACLES: dict[str, str] = {
    "label_distribution": f"""WITH {RAW}, counts AS (
  SELECT label, count(*) AS n FROM raw WHERE label IS NOT NULL GROUP BY label)
SELECT label, CASE label WHEN 1 THEN 'spam' ELSE 'not spam' END AS label_name, n,
       round_even(n / sum(n) OVER (), 6) AS share,
       round_even(100.0::DOUBLE * n / sum(n) OVER (), 2) AS percent
FROM counts ORDER BY label""",
    "source_label_report": f"""WITH {RAW}
SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source,
       CASE WHEN grouping(label) = 1 THEN 'all'
            ELSE coalesce(CAST(label AS VARCHAR), 'none') END AS label, count(*) AS n
FROM raw GROUP BY ROLLUP (source, label)""",
    "table_shape": f"WITH {RAW} SELECT count(*) AS n_rows, 5 AS n_columns FROM raw",
    "null_counts": f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM raw" for c in PROFILED
    ),
    "missing_ratio": f"WITH {RAW} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        f"round_even(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) "
        "AS missing_ratio FROM raw"
        for c in PROFILED
    )
    + ") WHERE missing_ratio > 0 ORDER BY missing_ratio DESC, column_name",
    "column_profile": f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, "
        f"count({c}) AS n_non_null FROM raw"
        for i, (c, t) in enumerate(zip(PROFILED, PROFILE_TYPES, strict=True))
    ),
    "length_describe": f"SELECT {describe()} FROM documents",
    "length_describe_by_label": f"""WITH {CLEAN}
SELECT {describe("label,")} FROM cleaned GROUP BY label""",
    "length_histogram": f"""WITH {NORM}, lengths AS (
  SELECT CAST(label AS INTEGER) AS label, length(text) AS length FROM norm WHERE label IN (0, 1)),
ranges AS (SELECT label, min(length) AS low, max(length) AS high FROM lengths GROUP BY label),
bins AS (SELECT label, low, high, CAST(bin AS INTEGER) AS bin
         FROM ranges, (SELECT unnest(range(50)) AS bin)),
placed AS (SELECT l.label, least((l.length - r.low) * 50 // (r.high - r.low), 49) AS bin
           FROM lengths l JOIN ranges r ON l.label = r.label),
counts AS (SELECT label, bin, count(*) AS n FROM placed GROUP BY label, bin)
SELECT b.label, b.bin,
       round_even(b.low + CAST(b.high - b.low AS DOUBLE) * b.bin / 50, 6) AS bin_start,
       round_even(b.low + CAST(b.high - b.low AS DOUBLE) * (b.bin + 1) / 50, 6) AS bin_end,
       coalesce(c.n, 0) AS n
FROM bins b LEFT JOIN counts c ON b.label = c.label AND b.bin = c.bin""",
    "head_rows": f"""WITH {NORM}
SELECT row_index, source, file_name, label, label_name, subject, substring(text, 1, 80) AS preview
FROM norm ORDER BY row_index LIMIT 5""",
    "schema_normalised": f"""
SELECT d.doc_id, d.source, '' AS file_name, CAST(1 - l.quality AS DOUBLE) AS label,
       CASE 1 - l.quality WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' ELSE '' END AS label_name,
       '' AS subject, {strip("d.text")} AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "binary_label_map": """
SELECT doc_id, CASE WHEN toxic = 1 THEN 2 ELSE 1 - quality END AS label,
       CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END AS binary_label
FROM labels""",
    "label_synonyms": """
SELECT d.doc_id,
       CASE WHEN l.quality IS NULL THEN d.lang
            WHEN l.quality = 1 THEN CASE WHEN l.toxic = 1 THEN 'PHISHING' ELSE ' Ham' || chr(10) END
            ELSE CASE WHEN l.toxic = 1 THEN 'Malicious' ELSE 'True' END END AS word,
       CASE WHEN l.quality IS NULL THEN NULL
            WHEN l.quality = 1 AND l.toxic = 0 THEN 0 ELSE 1 END AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "merged_sources": """
SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS characters FROM (
  SELECT source, text FROM documents
  UNION ALL SELECT 'chat_' || role, text FROM conversations
  UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY source""",
    "mail_split": "SELECT doc_id, lang || ' ' || source AS subject, text FROM documents",
    "csv_roundtrip": f"WITH {NORM} SELECT * FROM norm",
    "csv_in_splits": f"""
SELECT lang, count(*) AS n, count(*) AS n_keys, max(doc_id) AS last_doc,
       CAST(sum({first_digits("coalesce(text, '')")}) AS BIGINT) AS checksum FROM documents GROUP BY lang""",
    "source_partitioned_table": """
SELECT source, count(*) AS n, max(doc_id) AS last_row FROM documents GROUP BY source""",
    "quality_issues": f"WITH {FLAGGED} {ISSUE_ROWS}",
    "quality_issue_counts": f"""WITH {FLAGGED}, issues AS ({ISSUE_ROWS})
SELECT issue, count(*) AS n FROM issues GROUP BY issue""",
    "clean_messages": f"WITH {CLEAN} SELECT * FROM cleaned",
    "duplicate_flags": f"""WITH {FLAGGED}
SELECT row_index, label, duplicate_label_text AS is_duplicate FROM flagged""",
    "duplicate_row_keys": f"WITH {FLAGGED} SELECT row_index FROM flagged WHERE duplicate_label_text",
    "whole_row_distinct": "SELECT DISTINCT lang, text FROM documents",
    "quality_summary": SUMMARY,
    "sanity_checks": f"""WITH {NORM}, done AS (SELECT label, {cleaned("text")} AS c FROM norm)
SELECT count(*) AS rows, count(*) FILTER (c IS NULL) AS violations_clean_text_present,
       count(*) FILTER (c = '') AS violations_clean_text_filled,
       count(*) FILTER (label IS NULL OR label NOT IN (0, 1)) AS violations_label_known
FROM done""",
    "quality_job": SUMMARY,
    "full_run": FULL_RUN,
    "balanced_sample": f"WITH {BALANCED} SELECT * FROM balanced",
    "class_sizes": f"""WITH {CLEAN}, sizes AS (
  SELECT label, count(*) AS size FROM cleaned GROUP BY label)
SELECT label, size, min(size) OVER () AS smallest, count(*) OVER () AS n_classes FROM sizes""",
    "capped_sample": f"""WITH {RANKED}
SELECT label, row_index FROM ranked
WHERE n_all <= 60 OR rk <= greatest(1, 60 // (SELECT count(DISTINCT label) FROM ranked))""",
    "stratified_split": f"""WITH {RANKED}, sizes AS (
  SELECT DISTINCT label, n_label, n_all,
         CAST(ceil(CAST({settings.TEST_SHARE} AS DOUBLE) * n_all) AS BIGINT) AS n_test
  FROM ranked), parts AS (
  SELECT *, n_test * n_label // n_all AS whole, n_test * n_label % n_all AS rest FROM sizes),
quotas AS (
  SELECT label, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                             <= n_test - sum(whole) OVER () THEN 1 ELSE 0 END AS quota
  FROM parts)
SELECT r.label, r.row_index, r.rk <= q.quota AS is_test
FROM ranked r JOIN quotas q ON r.label = q.label""",
    "random_split": f"""
SELECT doc_id, lang, row_number() OVER (ORDER BY {hashed("doc_id")}, doc_id)
         <= ceil(CAST({settings.TEST_SHARE} AS DOUBLE) * count(*) OVER ()) AS is_test
FROM documents""",
    "seeded_shuffle": f"""
SELECT doc_id, lang, {hashed("doc_id")} AS order_hash FROM documents ORDER BY order_hash, doc_id""",
    "pages_without_markup": f"SELECT page_id, {markup('html')} AS text FROM pages",
    "entity_tokens": f"SELECT doc_id, {entities('text')} AS text FROM documents",
    "entity_tokens_pages": f"""
SELECT page_id, {entities("url || ' ' || html")} AS text FROM pages""",
    "letters_only": f"SELECT doc_id, {letters('text')} AS text FROM documents",
    "stopwords_removed": f"""
SELECT doc_id, {without_words(
        f"string_split_regex({strip('text')}, '[{SPACE_CLASS}]+')",
        [*SHORT_STOPWORDS, "que", "aux"])} AS text FROM documents""",
    "french_stopwords_removed": f"""
SELECT doc_id, {without_words(
        f"string_split_regex({strip('text')}, '[{SPACE_CLASS}]+')",
        shipped_stopwords("french"))} AS text FROM documents WHERE lang = 'fr'""",
    "clean_text_documents": f"SELECT doc_id, {cleaned('text')} AS clean_text FROM documents",
    "clean_text_pages": f"SELECT page_id, {cleaned('html')} AS clean_text FROM pages",
    "clean_text_min_length": f"""
SELECT * FROM (SELECT conv_id, turn, {cleaned("text")} AS clean_text FROM conversations)
WHERE length(clean_text) >= 100""",
    "preprocessing_job": f"""
SELECT lang, count(*) AS n, CAST(sum(length(c)) AS BIGINT) AS characters
FROM (SELECT lang, {cleaned("text")} AS c FROM (SELECT DISTINCT lang, text FROM documents
      WHERE text IS NOT NULL)) GROUP BY lang""",
    "manual_features": f"SELECT doc_id, {manual('text')} FROM documents",
    "manual_features_pages": f"""
SELECT page_id, {manual("x")} FROM (SELECT page_id, url || html AS x FROM pages)""",
    "vocabulary_topk": f"""WITH {term_rows("documents", "doc_id", SHORT_STOPWORDS)}
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM terms GROUP BY term
ORDER BY tf DESC, term LIMIT {settings.MAX_FEATURES}""",
    "term_statistics": f"""WITH {term_rows("documents", "doc_id", SHORT_STOPWORDS, bigrams=False)}
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM terms GROUP BY term""",
    "tfidf_weights": f"""WITH {term_rows("documents", "doc_id", SHORT_STOPWORDS)},
{weight_rows("documents", "doc_id", settings.MAX_FEATURES)}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights""",
    "nb_log_theta": f"""WITH {BALANCED}, {term_rows("balanced", "row_index", SHORT_STOPWORDS)},
{weight_rows("balanced", "row_index", settings.MAX_FEATURES)}, {theta_rows("balanced", "row_index")}
SELECT label, term, round(log_theta, 6) AS log_theta FROM theta""",
    "confusion_counts": f"WITH {RULES} SELECT * FROM cells",
    "model_metrics": f"WITH {METRICS} SELECT * FROM metrics",
    "metrics_compare": f"WITH {METRICS} SELECT * FROM metrics ORDER BY {RANKING}",
    "best_model": f"WITH {METRICS} SELECT * FROM metrics ORDER BY {RANKING} LIMIT 1",
    "quality_gate": f"""WITH {METRICS}
SELECT model, f1_spam, recall_spam, f1_spam >= 0.9 AND recall_spam >= 0.9 AS passed
FROM metrics ORDER BY {RANKING} LIMIT 1""",
    "confusion_long": f"WITH {RULES} "
    + " UNION ALL ".join(
        f"SELECT model, {i} AS position, '{cell}' AS cell, '{truth}' AS true_label, "
        f"'{guess}' AS predicted_label, {cell.lower()} AS n FROM cells"
        for i, (cell, truth, guess) in enumerate(
            [
                ("TN", "not spam", "not spam"),
                ("FP", "not spam", "spam"),
                ("FN", "spam", "not spam"),
                ("TP", "spam", "spam"),
            ]
        )
    ),
    "plain_accuracy": f"""WITH {RULES}
SELECT round(avg(CASE WHEN label = by_exclamation THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS accuracy FROM rules""",
    "prediction_alignment": """
WITH p AS (SELECT doc_id FROM documents WHERE n_chars >= 500)
SELECT count(*) FILTER (l.doc_id IS NOT NULL AND p.doc_id IS NOT NULL) AS matched,
       count(*) FILTER (l.doc_id IS NOT NULL AND p.doc_id IS NULL) AS without_prediction,
       count(*) FILTER (l.doc_id IS NULL AND p.doc_id IS NOT NULL) AS without_truth
FROM labels l FULL OUTER JOIN p ON l.doc_id = p.doc_id""",
    "aligned_accuracy": f"""
SELECT round(avg(CASE WHEN 1 - l.quality = CASE WHEN {count_char("d.text", "!")} >= 3
                 THEN 1 ELSE 0 END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "positional_accuracy": f"""
SELECT count(*) AS n, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS positions,
       round(avg(CASE WHEN 1 - l.quality = CASE WHEN {count_char("d.text", "!")} >= 3
                 THEN 1 ELSE 0 END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "margin_scores": f"""WITH {term_rows("documents", "doc_id", SHORT_STOPWORDS)},
{weight_rows("documents", "doc_id", settings.MAX_FEATURES)}, margins AS (
  SELECT doc_id, sum(weight * 8 * ({first_digits("term")} / 4294967296.0::DOUBLE - 0.5)) AS m FROM weights GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(m.m, 0) - 0.25 AS m FROM documents d LEFT JOIN margins m ON m.doc_id = d.doc_id)
SELECT doc_id, CAST(m > 0 AS INTEGER) AS label, CASE WHEN m > 0 THEN 'spam' ELSE 'not spam' END AS prediction,
       round_even(1 / (1 + exp(-m)), 6) AS spam_score
FROM scored""",
    "roc_auc": f"""WITH {CLEAN}, scored AS (
  SELECT label, {upper_ratio("text")} AS score FROM cleaned), placed AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE
           AS avg_rank
  FROM scored), sums AS (
  SELECT count(*) FILTER (label = 1) AS n_spam, count(*) FILTER (label = 0) AS n_ham,
         sum(avg_rank) FILTER (label = 1) AS ranks
  FROM placed)
SELECT n_spam, n_ham,
       round_even((ranks - n_spam * (n_spam + 1) / 2.0::DOUBLE)
                  / (CAST(n_spam AS DOUBLE) * n_ham), 6) AS roc_auc
FROM sums""",
    "sigmoid_score": f"""
SELECT doc_id, round_even(1 / (1 + exp(-(40 * ({upper_ratio("text")}) - 1))), 6) AS spam_score
FROM documents""",
    "lenient_metrics": f"""WITH {CLEAN}, answers AS (
  SELECT label, CASE WHEN length(text) >= 2000 THEN NULL
                     WHEN {count_char("text", "!")} >= 3 THEN 1 ELSE 0 END AS by_exclamation,
         CASE WHEN length(text) < 400 THEN 1 ELSE 0 END AS by_length
  FROM cleaned), predictions AS (
  SELECT 'by_exclamation' AS model, label, by_exclamation AS prediction FROM answers
  UNION ALL SELECT 'by_length', label, by_length FROM answers), cells AS (
  SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (prediction IS NULL) AS unparsed
  FROM predictions GROUP BY model), rates AS (
  SELECT *, tn + fp + fn + tp AS total, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r
  FROM cells)
SELECT model, round({ratio("tp + tn", "total")}, 6) AS accuracy, round(p, 6) AS precision_spam,
       round(r, 6) AS recall_spam, round({ratio("2 * p * r", "p + r")}, 6) AS f1_spam,
       round({ratio("fp", "fp + tn")}, 6) AS false_positive_rate, tn, fp, fn, tp, total, unparsed
FROM rates""",
    "train_sizes": f"""WITH {SPLIT}
SELECT model, count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
       count(*) FILTER (is_test AND label = 0) AS test_ham, count(*) FILTER (is_test AND label = 1) AS test_spam
FROM parted, (SELECT unnest([{sql_list(MODELS)}]) AS model) GROUP BY model""",
    "train_naive_bayes": f"""WITH {SPLIT}, runs AS (
  SELECT 0 AS run, row_index, label, NOT is_test AS in_train FROM parted), {naive_bayes_runs("parted")}, cells AS (
  SELECT 'naive_bayes' AS model, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM predicted WHERE NOT in_train), rates AS (
  SELECT *, tn + fp + fn + tp AS total, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r
  FROM cells)
SELECT model, round({ratio("tp + tn", "total")}, 6) AS accuracy, round(p, 6) AS precision_spam,
       round(r, 6) AS recall_spam, round({ratio("2 * p * r", "p + r")}, 6) AS f1_spam,
       round({ratio("fp", "fp + tn")}, 6) AS false_positive_rate, tn, fp, fn, tp, total
FROM rates""",
    "train_compare": f"""WITH RECURSIVE {TRAINED}
SELECT model, round(accuracy, 6) AS accuracy, round(precision_spam, 6) AS precision_spam, round(recall_spam, 6) AS recall_spam,
       round(f1_spam, 6) AS f1_spam, round(false_positive_rate, 6) AS false_positive_rate, tn, fp, fn, tp, total,
       CAST((SELECT count(*) FROM runs WHERE in_train) AS INTEGER) AS train_rows,
       CAST((SELECT count(*) FROM runs WHERE NOT in_train) AS INTEGER) AS test_rows
FROM trained""",
    "best_model_scores": BEST_SCORES,
    "learning_curve": f"""WITH {CURVE}, cells AS (
  {cell_counts("run, in_train", "predicted")}), rates AS (
  SELECT *, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r FROM cells)
SELECT 'naive_bayes' AS model, {CURVE_COLUMNS}
FROM rates r JOIN grid g ON r.run = g.run JOIN sizes s ON s.run = r.run""",
    "learning_curve_solvers": f"""WITH RECURSIVE {CURVE}, {solver_runs()}, guesses AS (
  SELECT run, loss, in_train, label, CAST(f > 1e-9 AS INTEGER) AS prediction FROM solver_margins
  UNION ALL  -- a training set of one class predicts it, whatever the model
  SELECT p.run, m.loss, p.in_train, p.label, p.prediction FROM predicted p JOIN sizes s ON s.run = p.run
  CROSS JOIN (SELECT unnest(['logistic', 'squared_hinge']) AS loss) m WHERE s.n0 = 0 OR s.n1 = 0), cells AS (
  {cell_counts("run, loss, in_train", "guesses")}), rates AS (
  SELECT *, {ratio("tp", "tp + fp")} AS p, {ratio("tp", "tp + fn")} AS r FROM cells)
SELECT {LOSS_NAMES} AS model, {CURVE_COLUMNS}
FROM rates r JOIN grid g ON r.run = g.run JOIN sizes s ON s.run = r.run""",
    "combined_features": f"""WITH {term_rows("documents", "doc_id", shipped_stopwords("english"))},
{weight_rows("documents", "doc_id", settings.MAX_FEATURES)}, places AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS place FROM vocab), hand AS (
  SELECT doc_id, {manual("coalesce(text, '')")} FROM documents)
SELECT w.doc_id, p.place, round(w.weight, 6) AS value FROM weights w JOIN places p ON w.term = p.term
UNION ALL
SELECT doc_id, CAST((SELECT count(*) FROM vocab) + i AS INTEGER), round(value, 6) FROM (
  SELECT doc_id, unnest([0, 1, 2, 3, 4]) AS i, unnest([CAST(length AS DOUBLE), CAST(url_count AS DOUBLE),
         CAST(exclamation_count AS DOUBLE), CAST(dollar_count AS DOUBLE), uppercase_ratio]) AS value
  FROM hand) WHERE value <> 0""",
    "batch_scores": SCORES,
    "stream_scores": SCORES + f" WHERE {strip('d.original')} <> ''",
}
ORACLES["evaluation_job"] = ORACLES["metrics_compare"]
ORACLES["json_report"] = ORACLES["source_label_report"]
