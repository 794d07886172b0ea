"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses; the words of a clause become tags (insult, threat, target, negation, reported
speech, other) and pass through a composition of letter-to-letter transducers:

    insult      a word of the lexicon, or a phrase of several words ("piece of trash"), is an insult
    threat      a violent act with a person as its object ("strangle him"), or a phrase of several words ("beat you
                to death"), is an accepted threat; a violent word alone is a threat, but not an accepted one
    negation    an insult or threat up to three words after a negation is marked as negated
    reported    an insult or threat after a verb of saying, or a word for words ("the term"), is marked as reported
    target      an insult or threat up to four words after (second reading, from the right: before) a word for
                a person is marked as aimed

The phrases are one machine over words, read from the right, so that it speaks at the first word of a phrase. The
marks are one machine over (insult | threat) x marks, made by a product of states. Clauses score, not words:
a clause counts once for each kind, by its strongest match, as aimed (of threats: accepted), plain, negated or reported.
A clause with an insult that is neither negated nor reported, or such an accepted threat, is a match; isolated,
negated or reported words are none, and their features have weights of their own.

Lexicon: fixed seed words, and stems learned from labelled rows: prefixes of up to six letters, or whole
words, that occur in toxic rows and almost only there, chosen greedily by how many toxic rows they explain
that none before explained (so that the words of one much-copied text do not count as evidence each). At most
``MAX_STEMS`` of the ``CANDIDATES`` most frequent are kept. A learned stem is a threat if most of its occurrences in
toxic rows follow a word of intent and have a person as object, else an insult.
Weights: logistic regression with a prior on the marked counts. Both are fitted on at most ``TRAIN_ROWS``
distinct labelled texts (a documented bound; those with the smallest hash), never on held-out ones; doc_id, lang,
source and the labels are not inputs of a score. Every text is scored whole.

Defined results: a null or empty text has no clauses and the score of a text without matches; a null doc_id
is not held out and never labelled; of contradicting labels the toxic one holds; without labelled rows the
prior alone scores; repeated rows score alike; of two matches of a clause that are as strong the heavier counts;
an empty table gives an empty result; a very long text takes time and memory in proportion to its length; other
columns are kept, but for one named score, which the score replaces (``drop_toxic`` keeps it).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.llm.common import fresh, text_or_empty

TRAIN_ROWS = 8000
MAX_STEMS = 200
CANDIDATES = 20_000
MIN_ROWS = 5
MIN_PURITY = 0.9

# Seed words of the grammar (English, German, French, Spanish).
INSULTS = frozenset("idiot idiots moron morons scum trash loser losers pathetic worthless disgusting stupid clown".split())
THREATS = frozenset("kill murder destroy strangle umbringen töten erschlagen tuer frapper égorger matar golpear".split())
TARGETS = frozenset("you your yours he she they him her them du dein ihr euch tu toi vous ton tú usted ustedes te".split())
NEGATIONS = frozenset("not no never nobody isn aren don nicht kein keine nie pas jamais aucun nunca jamás ningún".split())
#: Words that name a word instead of using it, and words of intent before a threat.
MENTIONS = frozenset("word words term terms phrase wort begriff mot terme palabra término".split())
INTENTS = frozenset("will gonna going shall ll werde wirst vais vas voy vamos".split())
#: Phrases by kind: the words that may stand at each place, and how many other words may stand between two places.
#: ``VIOLENT`` stands for the words of the threat lexicon.
VIOLENT = frozenset({"<violent>"})
_YOU = frozenset("you him her them dich euch te toi vous ti usted ustedes".split())
PHRASES = (
    ("threat", (VIOLENT, _YOU), 1),
    ("threat", (frozenset("beat kick stab choke burn hack bash smash".split()), _YOU, frozenset("death pulp bits pieces ashes".split())), 2),
    ("threat", (frozenset("break cut slit smash".split()), frozenset("your his her their".split()), frozenset("neck throat skull bones legs".split())), 1),
    ("threat", (frozenset("know find".split()), frozenset({"where"}), frozenset({"you"}), frozenset("live sleep".split())), 1),
    ("threat", (frozenset({"make"}), _YOU, frozenset("regret suffer bleed".split())), 1),
    ("insult", (frozenset({"piece"}), frozenset({"of"}), frozenset("trash garbage filth dirt".split())), 0),
    ("insult", (frozenset({"waste"}), frozenset({"of"}), frozenset("space oxygen skin".split())), 0),
)
REPORTS = frozenset("said says say called calls claimed wrote quoted sagte sagt nannte dit disait appelé dijo dice llamó".split())

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")

OTHER, TARGET, NEGATION, REPORT = "other", "target", "negation", "report"
KINDS, MARKS = ("insult", "threat"), ("negated", "reported", "aimed")


@dataclass(frozen=True)
class Transducer:
    """A letter-to-letter machine: ``step(state, symbol)`` gives the next state and the symbol put out.

    Symbols are the tags above, or (kind, marks) with a frozenset of marks.
    """

    start: object
    step: object = field(compare=False)

    def compose(self, after: Transducer) -> Transducer:
        """First this machine, then ``after`` on what it puts out."""

        def step(state, symbol):
            one, symbol = self.step(state[0], symbol)
            two, symbol = after.step(state[1], symbol)
            return (one, two), symbol

        return Transducer((self.start, after.start), step)

    def compiled(self, symbols) -> dict:
        """The reachable (state, symbol) -> (state, symbol) table."""
        table, todo = {}, [self.start]
        seen = {self.start}
        while todo:
            state = todo.pop()
            for s in symbols:
                table[state, s] = to, _ = self.step(state, s)
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return table


def _within(cue: str, mark: str, reach: float) -> Transducer:
    """Marks insults and threats up to ``reach`` words after a cue; the state is how many words remain."""

    def step(left, symbol):
        if symbol == cue:
            return reach, symbol
        if isinstance(symbol, tuple) and left > 0:
            symbol = (symbol[0], symbol[1] | {mark})
        return max(left - 1, 0) if reach != math.inf else left, symbol

    return Transducer(0, step)


def _symbols() -> list:
    marks = [frozenset(m for m, on in zip(MARKS, bits, strict=True) if on) for bits in product((0, 1), repeat=3)]
    return [OTHER, TARGET, NEGATION, REPORT, *((k, m) for k in KINDS for m in marks)]


_AIMED = _within(TARGET, "aimed", 4)
FORWARD = _within(NEGATION, "negated", 3).compose(_within(REPORT, "reported", math.inf)).compose(_AIMED)
FORWARD_TABLE, BACKWARD_TABLE = FORWARD.compiled(_symbols()), _AIMED.compiled(_symbols())


def _read(table: dict, state, tags: list) -> list:
    out = []
    for t in tags:
        state, t = table[state, t]
        out.append(t)
    return out


def transduced(tags: list) -> list:
    """A clause's tags with their marks."""
    first = _read(FORWARD_TABLE, FORWARD.start, tags)
    return _read(BACKWARD_TABLE, _AIMED.start, first[::-1])[::-1]


def phrase_machine(phrases=PHRASES) -> Transducer:
    """Reads the sets of phrase words that a word belongs to, from the right, and puts out the kinds of the phrases
    that begin at the word. The state holds the phrases that are open: (phrase, place, words that may still be skipped)."""

    def step(state, sets):
        found, then = set(), set()
        for p, (kind, places, gap) in enumerate(phrases):
            last = len(places) - 1
            for place, left in {(at, n) for q, at, n in state if q == p} | {(last, 0)}:
                if places[place] in sets:
                    if place:
                        then.add((p, place - 1, gap))
                    else:
                        found.add(kind)
                if place < last and left:
                    then.add((p, place, left - 1))
        return frozenset(then), frozenset(found)

    return Transducer(frozenset(), step)


_SPOTTER = phrase_machine()
_PLACES = frozenset(place for _, places, _ in PHRASES for place in places)

FEATURES = ("any", "insult", "insult aimed", "insult negated", "insult reported", "threat", "threat aimed", "threat negated", "threat reported")
#: Prior weights, before any label: "any" (a matched clause) speaks for toxic, an aimed one more; clauses that are only
#: negated, reported or hold a violent word match nothing and hardly speak.
PRIOR = np.array([2.0, 0.5, 2.0, -0.7, -0.4, 0.2, 3.0, -0.4, -0.3])
PRIOR_BIAS = -2.5


class Lexicon:
    """Stems (prefixes with ``*``, whole words without) that mark insults, or threats if in ``threats``."""

    def __init__(self, stems: dict[str, float], threats: frozenset[str] = frozenset()):
        import ahocorasick

        self.insults = dict.fromkeys(INSULTS, 1.0) | {s: w for s, w in stems.items() if s not in threats}
        self.threats = dict.fromkeys(THREATS, 1.0) | {s: w for s, w in stems.items() if s in threats}
        self.longest = max((len(s) - 1 for s in stems if s.endswith("*")), default=0)
        self.hints = ahocorasick.Automaton()
        # every match has one of these: a stem, or the last word of a phrase
        ends = {w for _, places, _ in PHRASES for w in places[-1] if VIOLENT not in places}
        for s in {*(x.rstrip("*") for x in (*self.insults, *self.threats)), *ends}:
            self.hints.add_word(s, s)
        self.hints.make_automaton()
        self.spotted: dict = {}

    def weight(self, word: str, stems: dict[str, float]) -> float:
        """The word's weight by its whole form or its heaviest prefix, 0 if it has none."""
        if (w := stems.get(word)) is not None:
            return w
        return max((stems.get(f"{word[:n]}*", 0.0) for n in range(3, min(len(word), self.longest) + 1)), default=0.0)

    def insult(self, word: str) -> float:
        return self.weight(word, self.insults)

    def threat(self, word: str) -> float:
        return self.weight(word, self.threats)

    def tag(self, word: str):
        if self.insult(word) > 0:
            return ("insult", frozenset())
        if self.threat(word) > 0:
            return ("threat", frozenset())
        return TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS or word in MENTIONS else OTHER

    def phrases(self, words: list[str]) -> list[frozenset[str]]:
        """The kinds of the phrases that begin at each word."""
        state, out = _SPOTTER.start, []
        for word in reversed(words):
            sets = frozenset(p for p in _PLACES if word in p) | (frozenset({VIOLENT}) if self.threat(word) > 0 else frozenset())
            if (state, sets) not in self.spotted:  # the machine is compiled as far as texts need it
                self.spotted[state, sets] = _SPOTTER.step(state, sets)
            state, found = self.spotted[state, sets]
            out.append(found)
        return out[::-1]

    def matches(self, words: list[str]) -> list[tuple[str, str, float]]:
        """(kind, status, weight) of a clause: for each kind its strongest match; the status is aimed, plain,
        negated or reported. An aimed threat is an accepted one."""
        begun = self.phrases(words)
        tags = [(min(b), frozenset()) if b else self.tag(w) for w, b in zip(words, begun, strict=True)]
        best: dict[str, tuple[int, float, str]] = {}
        for word, b, t in zip(words, begun, transduced(tags), strict=True):
            if not isinstance(t, tuple):
                continue
            kind, marks = t
            aimed = "threat" in b if kind == "threat" else "aimed" in marks
            status = "reported" if "reported" in marks else "negated" if "negated" in marks else "aimed" if aimed else "plain"
            weight = self.threat(word) if kind == "threat" else self.insult(word)
            weight = 1.0 if weight == 0 else max(weight, 0.1)  # a phrase weighs one
            best[kind] = max(best.get(kind, (0, 0.0, "")), (_STRENGTH[status], weight, status))
        return [(kind, status, weight) for kind, (_, weight, status) in best.items()]

    def counts(self, text: str | None) -> np.ndarray:
        """``FEATURES`` of the text: whether a clause matches, and the logs of one and the (weighted) numbers of
        clauses by kind and status."""
        out = np.zeros(len(FEATURES))
        low = (text or "").lower()
        if next(self.hints.iter(low), None) is None:
            return out
        live = False
        for clause in CLAUSE.split(low):
            if next(self.hints.iter(clause), None) is None:
                continue
            for kind, status, weight in self.matches(WORD.findall(clause)):
                out[FEATURES.index(kind if status == "plain" else f"{kind} {status}")] += weight
                live |= status == "aimed" or (kind, status) == ("insult", "plain")
        out[0] = float(live)
        out[1:] = np.log1p(out[1:])
        return out


_STRENGTH = {"reported": 1, "negated": 2, "plain": 3, "aimed": 4}


@dataclass(frozen=True)
class Model:
    stems: dict[str, float]
    threats: frozenset[str]
    weights: tuple[float, ...]
    bias: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` distinct texts of labelled documents that are not held out (copies of a
    text are one row, toxic if any label is); chosen by hash, so that the same rows are chosen anywhere."""
    given = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    given = given.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").alias("toxic"))
    hashed = F.xxhash64(text_or_empty())
    texts = documents.select("doc_id", hashed.alias("_h")).distinct().join(given, F.col("doc_id") == F.col("_id")).groupBy("_h").agg(F.max("toxic").alias("toxic"))
    # bounded by ``rows`` hashes, so it can be sent to every task
    chosen = texts.orderBy("_h").limit(rows)
    found = documents.select(text_or_empty().alias("text"), hashed.alias("_of")).join(F.broadcast(chosen), F.col("_of") == F.col("_h"))
    return found.groupBy("text").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def _stems_of(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return {w for w in words if len(w) >= 3} | {f"{w[:n]}*" for w in words for n in (4, 5, 6) if len(w) > n}


def _counted(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """(stem, n): rows that each stem occurs in, summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                n.update(_stems_of(t) if only is None else _stems_of(t) & only)
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["stem", "n"])

    return rows.select("text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def learned_stems(rows: DataFrame) -> dict[str, float]:
    """Stems of toxic rows with their log odds, from training rows."""
    size = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = rows.where("toxic = 1"), rows.where("toxic = 0")
    found = _counted(toxic).where(F.col("n") >= MIN_ROWS).orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()
    pos = {r.stem: r.n for r in found}
    if not pos:
        return {}
    neg = {r.stem: r.n for r in _counted(clean, frozenset(pos)).collect()}
    odds = lambda s: math.log((pos[s] + 0.5) / (size.get(1, 0) + 1)) - math.log((neg.get(s, 0) + 0.5) / (size.get(0, 0) + 1))
    pure = frozenset(s for s in pos if pos[s] / (pos[s] + neg.get(s, 0)) >= MIN_PURITY and odds(s) > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_stems_of(t) & pure) for t in batch.column(0).to_pylist()], pa.list_(pa.string()))], ["stems"])

    # the toxic ones of the bounded rows, with bounded candidates
    where: dict[str, set[int]] = {}
    for i, r in enumerate(toxic.select("text").mapInArrow(run, "stems array<string>").toLocalIterator()):
        for s in r.stems:
            where.setdefault(s, set()).add(i)
    chosen: dict[str, float] = {}
    least = max(MIN_ROWS, size.get(1, 0) // 100)
    while where and len(chosen) < MAX_STEMS:
        best = max(where, key=lambda s: (len(where[s]), -neg.get(s, 0), len(s), s))
        explained = where.pop(best)
        if len(explained) < least:
            break
        chosen[best] = odds(best) / 4
        where = {s: left for s, rows_of in where.items() if (left := rows_of - explained)}
    return chosen


def learned_threats(rows: DataFrame, stems: dict[str, float]) -> frozenset[str]:
    """The stems that most often stand after a word of intent and have a person as object, in toxic training rows."""
    if not stems:
        return frozenset()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in batches:
            n: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                for clause in CLAUSE.split((text or "").lower()):
                    words = WORD.findall(clause)
                    for i, word in enumerate(words):
                        if lexicon.insult(word) == 0:
                            continue
                        threat = not INTENTS.isdisjoint(words[max(i - 3, 0) : i]) and not _YOU.isdisjoint(words[i + 1 : i + 3])
                        for s in stems.keys() & {word, *(f"{word[:k]}*" for k in (4, 5, 6))}:
                            n[s] += 1 if threat else -1
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["stem", "n"])

    found = rows.where("toxic = 1").select("text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    return frozenset(r.stem for r in found.where("n > 0").collect())


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    train = training_rows(documents, labels, rows).persist()
    stems = learned_stems(train)
    threats = learned_threats(train, stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems, threats)
        for batch in batches:
            counts = [lexicon.counts(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    seen = train.mapInArrow(run, "x array<double>, y int").groupBy("x", "y").count().collect()  # equal counts are one row
    train.unpersist()
    w, bias = _logistic(np.array([r.x for r in seen]).reshape(-1, len(FEATURES)), np.array([r.y for r in seen], float), np.array([r["count"] for r in seen], float))
    return Model(stems, threats, tuple(w), bias)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps for the weights that are most likely given the rows and a normal prior about ``PRIOR``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.append(PRIOR, PRIOR_BIAS)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + (w - prior)
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.eye(len(w)), slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with a column score (0 to 1)."""
    rest = documents.drop("score") if "score" in documents.columns else documents
    at = rest.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, w = Lexicon(model.stems, model.threats), np.array(model.weights)
        for batch in batches:
            z = [float(lexicon.counts(t) @ w) + model.bias for t in batch.column(at).to_pylist()]
            score = pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType())]))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under 0.5, with their columns."""
    kept = fresh(documents, "_score")
    clash = documents.withColumnRenamed("score", kept) if "score" in documents.columns else documents
    out = scored(clash, fit(documents, labels)).where("score < 0.5").drop("score")
    return out.withColumnRenamed(kept, "score").select(*documents.columns) if kept in out.columns else out.select(*documents.columns)


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, a row per document."""
    found = scored(documents.select("doc_id", "text"), fit(documents, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
