"""Document quality from its lines: a linear-chain conditional random field labels every line good or bad.

A line is described by the shape of its characters and words (``FEATURES``), each value in one of the bins of
``EDGES``. Its score adds up a weight for each bin of its own, of the line before and of the line after; a label
also depends on the label before it. Forward-backward gives every line's probability of being good, and a
document's quality is their mean weighted by length, mapped to a probability by a logistic curve.

Labels are of documents, so in training every line has its document's label. The model is fitted on the driver
on a bounded sample: the ``TRAIN_ROWS`` labelled ids with the smallest hash, one row per distinct text (its mean
label), without texts of over ``TRAIN_LINES`` lines. Only their bins (a byte per line and feature) are collected.
Scoring reads every text whole, in tasks, without a shuffle.

Edge cases. A null text counts as empty. Lines of white space only are left out; a text of nothing else is its
first line, so empty texts are scored too. Very long texts: a task holds about 100 bytes per code point of the
longest one, however many lines it has. Repeated rows score alike; a null id is never held out. Ties of the
sample's hash go by id. Labels or ids that are null teach nothing; without labels every score is 0.5. An empty
table has no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 8000
TRAIN_LINES = 2000
#: Rows whose crc32(id) mod FOLDS is HELD_OUT are never learned from.
FOLDS, HELD_OUT = 4, 2
#: Code points that a task describes at a time.
CHUNK = 1 << 20
#: Strength of the pull of all weights to zero, and rounds of the fit.
PRIOR = 0.02
ROUNDS = 60
#: A training document of more lines than this weighs as one of so many.
HEAVY = 20

EDGES = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])
BINS = len(EDGES) + 1
FEATURES = (
    "letters", "upper case letters", "digits", "punctuation", "symbols", "white space", "length", "mean word", "longest word",
    "words that end in a sign", "words without letters", "words seen before", "words equal to the last", "characters equal to the last",
    "sentence end", "capital start", "line seen before", "words of one character", "words in capitals",
)
LETTER, UPPER, DIGIT, PUNCT, SYMBOL, BLANK = (1 << i for i in range(6))


# --- lines as bins ------------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """What each code point is, as bits."""

    def kind(c: str) -> int:
        major = unicodedata.category(c)
        if c.isspace():
            return BLANK
        if major[0] in "LM":
            return LETTER | (UPPER if major in ("Lu", "Lt") else 0)
        return {"N": DIGIT, "P": PUNCT}.get(major[0], SYMBOL)

    table = np.full(sys.maxunicode + 1, SYMBOL, dtype=np.uint8)
    table[:0x30000] = [kind(chr(c)) for c in range(0x30000)]  # the planes above hold rare letters and private signs
    table[0x30000:0x40000] = LETTER
    return table


def _hash(points: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of code points; ``of`` is the stretch of each point."""
    place = (np.arange(len(points)) - starts[of]).astype(np.uint64)
    mixed = (points.astype(np.uint64) + 1) * np.uint64(0x9E3779B97F4A7C15) ^ (place * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.add.reduceat(mixed, starts)


def _seen_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier in the same group."""
    order = np.lexsort((np.arange(len(value)), value, group))
    again = np.zeros(len(value), dtype=bool)
    again[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return again


def describe(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines of some documents: bins (lines x features), length, document, and line number in its text."""
    joined = "\n".join(t or "" for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = classes()[points]
    ends = np.flatnonzero(points == 10)
    starts = np.append(0, ends[:-1] + 1)
    per_text = np.array([(t or "").count("\n") + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    line = np.repeat(np.arange(len(starts)), ends - starts + 1)
    chars = ends - starts
    size = np.maximum(chars, 1)

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int32), starts)

    blank = (kinds & BLANK) > 0
    letters = per_line(kinds & LETTER > 0)
    equal_last = np.append(False, points[1:] == points[:-1]) & ~blank
    in_word = ~blank
    word_starts = np.flatnonzero(in_word & np.append(True, blank[:-1]))
    word_ends = np.flatnonzero(in_word & np.append(blank[1:], True))
    words = np.bincount(line[word_starts], minlength=len(starts))
    some = np.maximum(words, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line[word_starts], weights=flags, minlength=len(starts)) / some

    if len(word_starts):
        sizes = word_ends - word_starts + 1
        inside = np.flatnonzero(in_word)
        word_of = np.repeat(np.arange(len(word_starts)), sizes)
        firsts = np.cumsum(sizes) - sizes
        hashes = _hash(points[inside], firsts, word_of)
        word_line = line[word_starts]
        before = _seen_before(word_line, hashes)
        last = np.append(False, (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1]))
        counts = {k: np.add.reduceat((kinds[inside] & k > 0).astype(np.int32), firsts) for k in (LETTER, UPPER)}
        sign_end = (kinds[word_ends] & (LETTER | DIGIT)) == 0
        longest = np.zeros(len(starts))
        np.maximum.at(longest, word_line, sizes)
        by_word = [
            share(sizes) / 20, longest / 40, share(sign_end), share(counts[LETTER] == 0), share(before), share(last),
            share(sizes == 1), share((counts[UPPER] == counts[LETTER]) & (counts[LETTER] > 1)),
        ]
        final, initial = np.zeros(len(starts), dtype=np.uint32), np.zeros(len(starts), dtype=bool)
        final[word_line] = points[word_ends]  # the last word of a line is written last
        initial[word_line[::-1]] = (kinds[word_starts[::-1]] & UPPER) > 0
    else:
        by_word = [np.zeros(len(starts))] * 8
        final, initial = np.zeros(len(starts), dtype=np.uint32), np.zeros(len(starts), dtype=bool)
    whole = _hash(points, starts, line)
    kept = words > 0
    repeated = _seen_before(doc, whole) & kept
    values = [
        letters / size, per_line(kinds & UPPER > 0) / np.maximum(letters, 1), per_line(kinds & DIGIT > 0) / size, per_line(kinds & PUNCT > 0) / size,
        per_line(kinds & SYMBOL > 0) / size, (per_line(blank) - 1) / size, np.log2(1 + chars) / 16, *by_word[:6], per_line(equal_last) / size,
        np.isin(final, [ord(c) for c in ".!?…。！？"]), initial, repeated, *by_word[6:],
    ]
    bins = np.stack([np.searchsorted(EDGES, v) for v in values], axis=1)
    empty = np.bincount(doc, weights=kept, minlength=len(texts)) == 0
    kept |= empty[doc] & (number == 0)
    return bins[kept].astype(np.uint8), size[kept], doc[kept], number[kept]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of at most ``CHUNK`` code points in all, a longer text alone, with the first one's place."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text or "") > CHUNK:
            yield at, held
            at, held, size = i, [], 0
        held.append(text)
        size += len(text or "") + 1
    if held:
        yield at, held


# --- the random field ---------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """``weights``: (own, previous, next) x feature x bin, for good over bad; ``steps``: scores of (previous label,
    label) with 0 good and 1 bad; ``curve``: slope and offset from a document's mean marginal to its probability."""

    weights: np.ndarray
    steps: np.ndarray
    curve: tuple[float, float]

    @staticmethod
    def blank() -> Model:
        return Model(np.zeros((3, len(FEATURES), BINS)), np.zeros((2, 2)), (1.0, 0.0))


def neighbours(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line has a line of its document before it, and one after it."""
    same = doc[1:] == doc[:-1]
    return np.append(False, same), np.append(same, False)


def line_scores(weights: np.ndarray, bins: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Score of good over bad of each line from its own bins and its neighbours'."""
    place = np.arange(len(FEATURES))
    own, before, after = (w[place, bins].sum(axis=1) for w in weights)
    has_before, has_after = neighbours(doc)
    score = own
    score[has_before] += before[:-1][has_before[1:]]
    score[has_after] += after[1:][has_after[:-1]]
    return score


def marginals(score: np.ndarray, steps: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over every document at once: each line's probability of (good, bad), the probability of each
    pair of labels of a line and the next one of its document (zero where there is none), and each document's
    log of the sum over all labellings."""
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    lengths = np.diff(np.append(starts, len(doc)))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")  # longer than t
    step = np.exp(steps - steps.max())
    half = np.abs(score) / 2
    emit = np.exp(np.stack([score / 2, -score / 2], axis=1) - half[:, None])
    forward, backward, scale = np.empty((len(doc), 2)), np.ones((len(doc), 2)), np.empty(len(doc))
    for t, n in enumerate(running):
        at = starts[:n] + t
        a = emit[at] if t == 0 else (forward[at - 1] @ step) * emit[at]
        scale[at] = a.sum(axis=1)
        forward[at] = a / scale[at][:, None]
    for t in range(len(running) - 2, -1, -1):
        at = starts[: running[t + 1]] + t
        b = (emit[at + 1] * backward[at + 1]) @ step.T
        backward[at] = b / b.sum(axis=1)[:, None]
    both = forward * backward
    both /= both.sum(axis=1)[:, None]
    pairs = np.zeros((len(doc), 2, 2))
    at = np.flatnonzero(neighbours(doc)[1])
    joint = forward[at][:, :, None] * step * (emit[at + 1] * backward[at + 1])[:, None, :]
    pairs[at] = joint / joint.sum(axis=(1, 2))[:, None, None]
    per_line = np.log(scale) + half
    per_line[neighbours(doc)[0]] += steps.max()
    total = np.zeros(len(starts))
    total[order] = np.add.reduceat(per_line, np.sort(starts))[np.argsort(np.argsort(starts))] if len(starts) else 0
    return both, pairs, total


def loss_and_slope(parameters: np.ndarray, bins: np.ndarray, doc: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the labels (``good`` and ``weight`` per document) with its gradient."""
    shape = (3, len(FEATURES), BINS)
    weights, steps = parameters[:-4].reshape(shape), parameters[-4:].reshape(2, 2)
    score = line_scores(weights, bins, doc)
    both, pairs, total = marginals(score, steps, doc)
    has_before, has_after = neighbours(doc)
    labels = good[doc]
    said = np.where(labels, score, -score) / 2 + np.where(has_before, np.where(labels, steps[0, 0], steps[1, 1]), 0)
    per_doc = np.bincount(doc, weights=said, minlength=len(good))
    loss = float((weight * (total - per_doc)).sum())
    off = weight[doc] * (both[:, 0] - labels)
    slope = np.empty(shape)
    shifted = (off, np.append(off[1:], 0) * has_after, np.append(0, off[:-1]) * has_before)  # a line's bins speak for its neighbours
    for k, o in enumerate(shifted):
        for f in range(len(FEATURES)):
            slope[k, f] = np.bincount(bins[:, f], weights=o, minlength=BINS)
    seen = (pairs * (weight[doc])[:, None, None]).sum(axis=0)
    told = weight[doc] * has_before
    seen -= np.diag([told[labels].sum(), told[~labels].sum()])
    gradient = np.append(slope.ravel(), seen.ravel())
    return loss + PRIOR * float(parameters @ parameters) * weight.sum() / 100, gradient + 2 * PRIOR * parameters * weight.sum() / 100


def minimised(f: Callable, x: np.ndarray, rounds: int = ROUNDS, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, slope = f(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way = slope.copy()
        steps = []
        for s, y in reversed(moves):
            a = (s @ way) / (s @ y)
            way -= a * y
            steps.append(a)
        if moves:
            s, y = moves[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.abs(slope).sum())
        for (s, y), a in zip(moves, reversed(steps), strict=True):
            way += (a - (y @ way) / (s @ y)) * s
        size = 1.0
        while True:
            new = x - size * way
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * size * (slope @ way) or size < 1e-6:
                break
            size /= 2
        if new_value >= value:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            moves = [*moves[-memory + 1 :], (s, y)]
        done = value - new_value < 1e-6 * abs(value)
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x


def quality(model: Model, bins: np.ndarray, size: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Length-weighted mean of the lines' probability of being good, per document."""
    both, _, _ = marginals(line_scores(model.weights, bins, doc), model.steps, doc)
    return np.bincount(doc, weights=both[:, 0] * size, minlength=n_docs) / np.bincount(doc, weights=size, minlength=n_docs)


def on_curve(curve: tuple[float, float], mean: np.ndarray) -> np.ndarray:
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-(curve[0] * np.log(mean / (1 - mean)) + curve[1])))


def fitted(bins: np.ndarray, size: np.ndarray, doc: np.ndarray, good: np.ndarray) -> Model:
    """A model of documents given as ``describe`` gives them, with a label each."""
    if not len(good):
        return Model.blank()
    lines = np.bincount(doc, minlength=len(good))
    weight = np.minimum(1.0, HEAVY / lines)
    start = np.zeros(3 * len(FEATURES) * BINS + 4)
    found = minimised(lambda p: loss_and_slope(p, bins, doc, good, weight), start)
    model = Model(found[:-4].reshape(3, len(FEATURES), BINS), found[-4:].reshape(2, 2), (1.0, 0.0))
    mean = np.clip(quality(model, bins, size, doc, len(good)), 1e-6, 1 - 1e-6)
    odds = np.log(mean / (1 - mean))

    def off(p: np.ndarray) -> tuple[float, np.ndarray]:
        slope = np.exp(p[0])  # rising, whatever the labels
        z = slope * odds + p[1]
        wrong = 1 / (1 + np.exp(-z)) - good
        loss = np.logaddexp(0, z).sum() - z[good].sum() + 0.5 * float(p @ p)
        return float(loss), np.array([(wrong * odds).sum() * slope, wrong.sum()]) + p

    shape = minimised(off, np.zeros(2))
    return Model(model.weights, model.steps, (float(np.exp(shape[0])), float(shape[1])))


# --- over a table --------------------------------------------------------------------------------------------

def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _described(batches: Iterator[pa.RecordBatch], use: Callable) -> Iterator[pa.RecordBatch]:
    """``use(rows of the batch, bins, length, document, line)`` for the texts (last column) of every chunk."""
    for batch in batches:
        for at, texts in chunks(batch.column(batch.num_columns - 1).to_pylist()):
            yield use(batch.slice(at, len(texts)), *describe(texts))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "quality") -> DataFrame:
    """The bounded sample: ``good`` (0 to 1), and the ``bins`` and lengths of each distinct text."""
    usable = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    rated = usable.groupBy(F.col(id_column).alias("key")).agg(F.avg(F.col(label).cast("double")).alias("good"))
    chosen = rated.orderBy(F.xxhash64("key"), "key").limit(TRAIN_ROWS)
    texts = docs.select(F.col(id_column).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    found = texts.join(F.broadcast(chosen), "key").where(lines <= TRAIN_LINES)  # TRAIN_ROWS ids at most are broadcast
    distinct = found.groupBy(F.sha2("text", 256).alias("same")).agg(F.avg("good").alias("good"), F.any_value("text").alias("text"))

    def as_bytes(rows: pa.RecordBatch, bins, size, doc, _) -> pa.RecordBatch:
        cuts = np.searchsorted(doc, np.arange(rows.num_rows + 1))
        per_doc = [(bins[a:b].tobytes(), size[a:b].astype(np.int64).tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.record_batch([rows.column(0), rows.column(1), pa.array([x for x, _ in per_doc], pa.binary()), pa.array([y for _, y in per_doc], pa.binary())], names=["same", "good", "bins", "size"])

    return distinct.select("same", "good", "text").mapInArrow(lambda it: _described(it, as_bytes), "same string, good double, bins binary, size binary")


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "quality") -> Model:
    rows = sorted(training_rows(docs, labels, id_column, text_column, label).collect(), key=lambda r: r.same)  # at most TRAIN_ROWS
    if not rows:
        return Model.blank()
    bins = [np.frombuffer(r.bins, np.uint8).reshape(-1, len(FEATURES)) for r in rows]
    size = np.concatenate([np.frombuffer(r["size"], np.int64) for r in rows])
    doc = np.repeat(np.arange(len(rows)), [len(b) for b in bins])
    return fitted(np.concatenate(bins), size, doc, np.array([r.good >= 0.5 for r in rows]))


def line_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every line that is not blank: id, line number from 0, length, and the probability that it is ``good``."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def lines(rows: pa.RecordBatch, bins, size, doc, number) -> pa.RecordBatch:
        both, _, _ = marginals(line_scores(model.weights, bins, doc), model.steps, doc)
        return pa.record_batch([rows.column(0).take(pa.array(doc)), pa.array(number, pa.int64()), pa.array(size, pa.int64()), pa.array(both[:, 0])], names=["id", "line", "length", "good"])

    found = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        lambda it: _described(it, lines), f"id {id_type}, line long, length long, good double"
    )
    return found.withColumnRenamed("id", id_column)


def document_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's ``score``: the probability that its label is good."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def score(rows: pa.RecordBatch, bins, size, doc, _) -> pa.RecordBatch:
        scores = on_curve(model.curve, quality(model, bins, size, doc, rows.num_rows))
        return pa.record_batch([rows.column(0), pa.array(scores)], names=["id", "score"])

    found = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        lambda it: _described(it, score), f"id {id_type}, score double"
    )
    return found.withColumnRenamed("id", id_column)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_column: str = "doc_id") -> DataFrame:
    """Every document's score, by a model learned from the labels that are not held out."""
    found = document_quality(docs, train(docs, labels, id_column), id_column)
    return found.select(id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
