"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, insult with a harmless sense, threat, target, negation,
reported speech, intensifier, determiner, or other. Small weighted transducers each know one thing:

* ``INTENSITY``: an intensifier raises the insult that follows it,
* ``TARGET``: an insult is raised by what it is aimed at, earlier in the clause,
* ``OBJECT``, read from the end of the clause: a threat counts if its object follows,
* ``NEGATION`` lowers what follows a negation within three words,
* ``REPORT`` lowers what somebody is reported to have said,
* ``LITERAL`` lowers words like "trash" after a determiner in a clause that addresses nobody.

``compose`` joins them to one machine whose factor on a word is the product of the parts'. A word
is a match if its weight times its factor reaches ``ACCEPT``; a clause scores the sum over its
matches, and a clause without a match has no score, whatever words stand in it. The strongest
clause, the sum over clauses and that sum per word of a text give its probability through a
logistic curve.

What is learned, on a sample of at most ``sample`` labelled rows that are not held out: how toxic
texts are in which a word of the lists stands (word weights); further insults as whole words;
stems of words that are still unexplained, because insults are inflected (a word has the weight
of its longest stem); and the curve. A word or stem must stand in at least ``SUPPORT`` different
surroundings of toxic texts, so that copies of one text teach nothing, and more often there than
chance explains. How many are learned follows from the evidence alone.

All documents are scored whole, in one pass without a shuffle. An Aho-Corasick automaton finds
the words; only clauses that hold an insult or a threat are read as symbols.

Defined results: null and empty texts, and texts without a match, have the low base score;
without labelled rows the lists and a fixed curve are used; of rows that repeat an id, one label
and one text count for learning, the smallest; null ids pass through; equal rows get equal
scores; an empty table gives an empty result; extra columns of any name are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import map_arrow, written
from mailsieve.llm.quality import labelled_sample

SAMPLE = 4000
SUPPORT = 8
PURITY = 0.5
EVIDENCE = 14.0  # nats of evidence against chance, about one in a million
STEM = (5, 8)
ACCEPT = 0.5
_LEAST_WORDS = 50
_PRIOR = 2.0

INSULTS = """
    idiot idiots idiotic moron morons moronic stupid scum loser losers pathetic worthless trash clown
    clowns disgusting dumb dumbass fool imbecile filth vermin bastard coward freak creep garbage jerk
    retard subhuman parasite pig swine cretin dimwit halfwit nitwit lowlife degenerate asshole bitch
    dummkopf abschaum vollidiot trottel arschloch versager ekelhaft wertlos
    imbécile crétin ordure connard connasse débile minable pourriture abruti
    estúpido estúpida imbécil idiota escoria basura inútil asqueroso asquerosa gilipollas
""".split()
THREATS = """
    kill hurt destroy beat punch stab shoot strangle burn hang murder rape attack crush
    töten umbringen verprügeln erschießen tuer frapper détruire matar golpear destruir apuñalar
""".split()
TARGETS = """
    you your yours yourself u ur he she him her his they them their these those people everyone
    du dich dir ihr euch sie er tu te toi vous ton ta il elle ils eux tú ti usted ustedes él ella ellos
""".split()
NEGATIONS = """
    not no never nobody nothing isn't aren't wasn't don't doesn't didn't cannot can't won't neither
    nicht kein keine nie niemals pas jamais aucun ni nunca jamás ningún
""".split()
REPORTS = """
    said says saying told called calls claimed claims reported quoted wrote accused according alleged
    sagte sagt nannte behauptete dit appelé affirmé dijo dice llamó afirmó
""".split()
INTENSIFIERS = "very so such total complete absolute utter fucking damn bloody really sehr so très muy tan".split()

# Words of the list above that mostly mean something else, and what stands before them then.
AMBIGUOUS = "trash garbage clown clowns pig swine filth vermin parasite creep jerk freak basura".split()
DETERMINERS = "the a an this that these those some any my our more less".split()

# Symbols, and the order in which lists claim a word.
_SYMBOLS = (
    ("A", AMBIGUOUS), ("I", INSULTS), ("T", THREATS), ("N", NEGATIONS), ("R", REPORTS), ("Q", INTENSIFIERS),
    ("Y", TARGETS), ("D", DETERMINERS),
)
_THREAT_WEIGHT = 0.35
_CLAUSE = re.compile(r"[.!?;:,\n|()\[\]{}\"“”]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


class Transducer:
    """States from 0; ``moves[state, symbol] = (next state, factor)``; others stay, with factor 1."""

    def __init__(self, moves: dict):
        self.moves = moves

    def step(self, state, symbol: str):
        return self.moves.get((state, symbol)) or self.moves.get((state, "*")) or (state, 1.0)


INTENSITY = Transducer({(0, "Q"): (1, 1.0), (1, "Q"): (1, 1.0), (1, "I"): (0, 1.25), (1, "A"): (0, 1.25), (1, "*"): (0, 1.0)})
TARGET = Transducer({(0, "Y"): (1, 1.0), (1, "I"): (1, 1.5), (1, "A"): (1, 1.5)})
NEGATION = Transducer(
    {(0, "N"): (1, 1.0)}
    | {(s, "*"): ((s + 1) % 4, 1.0) for s in (1, 2, 3)}
    | {(s, "N"): (0, 1.0) for s in (1, 2, 3)}
    | {(s, c): (0, 0.2) for s in (1, 2, 3) for c in "AIT"}
)
REPORT = Transducer({(0, "R"): (1, 1.0)} | {(1, c): (1, 0.2) for c in "AIT"})
# Company of a target, an intensifier or another insult leaves no harmless sense.
LITERAL = Transducer(
    {(s, c): (2, 1.0) for s in (0, 1) for c in "YIQ"}
    | {(0, "A"): (2, 1.0), (0, "D"): (1, 1.0), (1, "D"): (1, 1.0), (1, "A"): (0, 0.2), (1, "*"): (0, 1.0)}
)
# From the end of the clause.
OBJECT = Transducer({(s, "Y"): (1, 1.0) for s in (0, 1, 2)} | {(1, "T"): (0, 2.0), (2, "T"): (0, 2.0), (1, "*"): (2, 1.0), (2, "*"): (0, 1.0)})
FORWARD = (INTENSITY, TARGET, NEGATION, REPORT, LITERAL)
BACKWARD = (OBJECT,)


class Composed:
    """The product of transducers, built state by state as symbols come."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.start = (0,) * len(parts)
        self._known: dict = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float]:
        known = self._known.get((state, symbol))
        if known is None:
            moves = [part.step(s, symbol) for part, s in zip(self.parts, state, strict=True)]
            factor = 1.0
            for _, f in moves:
                factor *= f
            known = self._known[state, symbol] = (tuple(s for s, _ in moves), factor)
        return known


def compose(*parts: Transducer) -> Composed:
    return Composed(*parts)


@dataclass
class Grammar:
    """Word weights and the curve; fixed defaults where nothing was learned."""

    weights: dict[str, float] = field(default_factory=lambda: {w: 1.0 for w in INSULTS})
    stems: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float, float] = (-3.0, 4.0, 1.0, 0.0)

    def machine(self) -> Machine:
        return Machine(self)


class Machine:
    """A grammar made ready for reading texts."""

    def __init__(self, grammar: Grammar, forward: tuple = FORWARD, backward: tuple = BACKWARD):
        self.symbols = {}
        for symbol, words in reversed(_SYMBOLS):
            self.symbols |= dict.fromkeys(words, symbol)
        self.symbols |= {word: "I" for word in grammar.weights if self.symbols.get(word) != "A"}
        self.weights = dict.fromkeys(THREATS, _THREAT_WEIGHT) | grammar.weights
        self.curve = grammar.curve
        self.forward, self.backward = compose(*forward), compose(*backward)
        self.stems = grammar.stems
        self.finder = ahocorasick.Automaton()
        for word in {*self.weights, *self.stems}:
            self.finder.add_word(word, (len(word), word in self.stems))
        self.finder.make_automaton()

    def read(self, word: str) -> tuple[str, float]:
        """Symbol and weight of a word: of the lists, or by its longest stem."""
        symbol = self.symbols.get(word)
        if symbol is None:
            for size in range(min(len(word), STEM[1]), STEM[0] - 1, -1):
                weight = self.stems.get(word[:size])
                if weight is not None:
                    return "I", weight
        return symbol or ".", self.weights.get(word, 0.0)

    def clause(self, words: list[str]) -> float:
        """The sum over matches: words whose weight times both machines' factors is accepted."""
        read = [self.read(word) for word in words]
        scores, state = [], self.forward.start
        for symbol, weight in read:
            state, factor = self.forward.step(state, symbol)
            scores.append(weight * factor if symbol in "AIT" else 0.0)
        state = self.backward.start
        for i in range(len(read) - 1, -1, -1):
            state, factor = self.backward.step(state, read[i][0])
            scores[i] *= factor
        return sum(x for x in scores if x >= ACCEPT)

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses that hold an insult or a threat."""
        low = text.lower()
        scores, done = [], 0
        for end, (size, stem) in self.finder.iter(low):
            start = end + 1 - size
            if start < done or (start and low[start - 1].isalnum()):
                continue
            if not stem and low[end + 1 : end + 2].isalnum():
                continue
            begin = done
            for mark in _CLAUSE.finditer(low, done, start):
                begin = mark.end()
            mark = _CLAUSE.search(low, end + 1)
            done = mark.start() if mark else len(low)
            scores.append(self.clause(_WORD.findall(low, begin, done)))
        return scores

    def features(self, text: str | None) -> tuple[float, float, float, int]:
        """Strongest clause, logs of the sum over clauses and per 100 words, number of clauses
        that match. Texts of a few words count as ``_LEAST_WORDS``."""
        text = text or ""
        scores = [x for x in self.clauses(text) if x]
        total = sum(scores)
        words = max(_LEAST_WORDS, text.count(" ") + 1)
        return max(scores, default=0.0), math.log1p(total), math.log1p(100 * total / words), len(scores)

    def probability(self, *features: float) -> float:
        level, *slopes = self.curve
        level += sum(slope * x for slope, x in zip(slopes, features, strict=True))
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, level))))


def _surroundings(sample: DataFrame, keys) -> DataFrame:
    """key, toxic and clean: in how many different surroundings a key first stands, by label.

    ``keys`` makes the keys that a word counts under of column ``word``.
    """
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), lambda w: w != "")
    placed = F.transform(
        "words",
        lambda w, i: F.struct(
            w.alias("word"), i.alias("at"), F.get("words", i - 1).alias("before"), F.get("words", i + 1).alias("after")
        ),
    )
    first_words = (
        sample.select("doc_id", "label", words.alias("words"))
        .select("doc_id", "label", F.explode(placed).alias("w"))
        .groupBy("doc_id", "label", "w.word")
        .agg(F.min(F.struct("w.at", "w.before", "w.after")).alias("first"))
    )
    return (
        first_words.select("doc_id", "label", "first", F.explode(keys).alias("key"))
        .groupBy("doc_id", "label", "key")
        .agg(F.min("first").alias("first"))
        .groupBy("key", "label", "first.before", "first.after")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
    )


def _stems_of(known: list[str]):
    """Keys of words that no known word explains: their beginnings of ``STEM`` letters."""
    least, most = STEM
    lengths = F.sequence(F.lit(least), F.least(F.char_length("word"), F.lit(most)))
    beginnings = F.transform(lengths, lambda n: F.substring("word", F.lit(1), n))
    unexplained = (F.char_length("word") >= least) & ~F.col("word").isin(known)
    return F.when(unexplained, beginnings).otherwise(F.array().cast("array<string>"))


def _telling(base: float):
    """Keys that toxic texts hold often, purely, and beyond chance."""
    n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    evidence = n * (
        share * F.log(share / base)
        + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    )
    return (F.col("toxic") >= SUPPORT) & (share >= PURITY) & (evidence >= EVIDENCE)


def _feature_batches(grammar: Grammar):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar.machine()
        for batch in batches:
            found = [machine.features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([f[i] for f in found], pa.float64()) for i in range(3)]],
                ["doc_id", "label", "strongest", "total", "density"],
            )

    return work


def _logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton steps for a ridge-penalised logistic curve; no slope may fall."""
    x = np.hstack([np.ones((len(labels), 1)), features])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * features.shape[1]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (labels - p) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), *[max(0.0, float(slope)) for slope in w[1:]]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Grammar:
    chosen = written(
        labelled_sample(docs, labels, label, sample, id_col, text_col).where("label in (0, 1)"), "toxicity-sample"
    )
    base = chosen.agg(F.avg("label")).first()[0]
    if base is None or not 0 < base < 1:
        return Grammar()
    def weight(row, expected: float) -> float:
        return (row.toxic + _PRIOR * expected) / (row.toxic + row.clean + _PRIOR)

    # As many rows as the bounded sample has evidence for.
    grammar = Grammar()
    for row in _surroundings(chosen, F.array("word")).where(F.col("key").isin(INSULTS) | _telling(base)).collect():
        # Listed words are taken for insults, others for ordinary ones, until texts say otherwise.
        grammar.weights[row.key] = weight(row, 1.0 if row.key in INSULTS else base)
    for row in _surroundings(chosen, _stems_of(sorted(grammar.weights))).where(_telling(base)).collect():
        grammar.stems[row.key] = weight(row, base)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = map_arrow(
        chosen.select("doc_id", "label", "text"),
        _feature_batches(grammar),
        f"doc_id {kind}, label int, strongest double, total double, density double",
    ).collect()
    found.sort(key=lambda r: r.doc_id)
    if found:
        features = np.array([(r.strongest, r.total, r.density) for r in found])
        grammar.curve = _logistic(features, np.array([float(r.label) for r in found]))
    return grammar


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), strongest (score of the strongest clause), clauses of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar.machine()
        for batch in batches:
            found = [machine.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([machine.probability(*f[:3]) for f in found], pa.float64()),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[3] for f in found], pa.int64()),
                ],
                ["doc_id", "score", "strongest", "clauses"],
            )

    return map_arrow(
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")),
        work,
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, strongest double, clauses bigint",
    )


def drop_toxic(
    docs: DataFrame, grammar: Grammar, threshold: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar.machine()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            found = [machine.features(t) for t in batch.column(at).to_pylist()]
            keep = [machine.probability(*f[:3]) < threshold for f in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, work, schema).select(*names)
