"""Substring dedup by recompression: long word sequences that repeat across documents.

Parsing. A text is a sequence of word symbols. Each of ``ROUNDS`` rounds first names its maximal runs (symbol
and length), then deals all symbols by a hash bit into left and right ones and names each left symbol
followed by a right one as a pair. Names are hashes of what they stand for, so they agree over all documents
and tasks with no dictionary to build, and pairs never overlap. What a symbol becomes depends on its
neighbours alone: two equal stretches of text get equal symbols but for a few at their edges.

Anchors. For every window of ``window`` words the parse tells which symbols surely are the same wherever the
window occurs: a run step gives up the first and the last run inside it, a pair step gives up a right symbol
at its left edge and a left symbol at its right edge. Of these interior symbols the longest (then smallest
hash) is the window's anchor; a window without any takes its smallest word. Equal windows have equal anchors,
and neighbouring windows mostly share one: a document is cut into groups of at most ``GROUP`` consecutive
windows with one anchor, a row each.

Revealing and verifying. Anchors in two or more documents reveal repeats. Each group carries the hashes of its
first and last window. If both occur in documents with smaller ids, all words of the group are covered and
its other windows need not be looked at. For the anchors of groups that this leaves open, all windows of all
their groups are listed with their hashes, and those in a smaller document are found by an aggregate. A
window is identified by its anchor and a 64-bit hash of its words.

Passages in a third of all documents: groups are aggregated by anchor before the shuffle and joined with
AQE's skew splitting; no group of documents is ever gathered, and no pairs of documents are made.

Defined results: a null text has no words; texts shorter than a window keep all; equal rows are judged alike;
windows in rows with the same doc_id do not count against each other; a null doc_id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import fresh, stored, text_or_empty

WINDOW = 50
ROUNDS = 4
GROUP = 32
#: Words that a task parses at once (a longer document alone may exceed it).
BATCH_WORDS = 1 << 19
LAST = (1 << 63) - 1  # stands for a null doc_id in the order

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and \\t..\\r, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _run_step(sym, length, doc, lo, hi):
    """Maximal runs become one symbol; windows [lo, hi) of symbols give up their first and last run."""
    new = np.empty(len(sym), bool)
    new[0] = True
    new[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    times = np.diff(np.append(at, len(sym))).astype(np.uint64)
    named = np.where(times > 1, _mix(sym[at] + times * _B), sym[at])
    return named, np.add.reduceat(length, at), doc[at], number[lo] + 1, number[np.maximum(hi, 1) - 1]


def _pair_step(sym, length, doc, lo, hi, k):
    """Left symbols followed by right ones become pairs; windows give up what an outer symbol could take."""
    left = (_mix(sym + np.uint64(k) * _A) & np.uint64(1)).astype(bool)
    taken = np.zeros(len(sym), bool)
    taken[1:] = left[:-1] & ~left[1:] & (doc[1:] == doc[:-1])  # the right half of a pair
    at = np.flatnonzero(~taken)
    number = np.cumsum(~taken) - 1
    after = np.minimum(at + 1, len(sym) - 1)
    paired = taken[after] & (after > at)
    named = np.where(paired, _mix(sym[at] * _A + sym[after] * _B + np.uint64(k)), sym[at])
    first, last = np.minimum(lo, len(sym) - 1), np.maximum(hi, 1) - 1
    return named, np.add.reduceat(length, at), doc[at], number[first] + ~left[first], number[last] + ~left[last]


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least value in each [lo, hi), all of them non-empty."""
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1  # floor(log2)
    out = np.empty(len(lo), np.uint64)
    table, width = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            table = np.minimum(table[: len(table) - width], table[width:])
            width *= 2
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - width])
    return out


def anchors(sym: np.ndarray, doc: np.ndarray, starts: np.ndarray, window: int, rounds: int = ROUNDS) -> np.ndarray:
    """The anchor of the window at each of ``starts``; sym and doc: hash and document number of each word."""
    words, lo, hi = sym, starts, starts + window
    length = np.ones(len(sym), np.int64)
    for k in range(rounds):
        empty = lo >= hi
        sym, length, doc, lo, hi = _run_step(sym, length, doc, np.minimum(lo, len(sym) - 1), hi)
        lo = np.where(empty, hi, lo)
        empty = lo >= hi
        sym, length, doc, lo, hi = _pair_step(sym, length, doc, lo, hi, k)
        lo = np.where(empty, hi, lo)
    rank = (np.uint64(63) - np.minimum(length, 63).astype(np.uint64)) << np.uint64(58)
    rank |= _mix(sym) >> np.uint64(6)
    some = lo < hi
    out = np.empty(len(starts), np.uint64)
    out[some] = _range_min(rank, lo[some], hi[some])
    out[~some] = _range_min(_mix(words), starts[~some], starts[~some] + window)
    return out


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def window_hashes(sym: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A polynomial hash of the ``window`` word hashes from each start, wherever it stands."""
    power = _powers(window)[::-1]
    out = np.zeros(len(starts), np.uint64)
    for i in range(window):
        out += _mix(sym[starts + i]) * power[i]
    return _mix(out)


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def groups_of(texts: list[list[bytes]], window: int) -> dict[str, np.ndarray]:
    """The window groups of some documents (given as words, each at least a window long): at (number of the
    document), anchor, first and last window, and their hashes."""
    sizes = np.array([len(w) for w in texts])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    sym = np.concatenate([_hashed(w) for w in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(sym)) - begins[doc]
    starts = np.flatnonzero(place <= sizes[doc] - window)
    anchor, owner, place = anchors(sym, doc, starts, window), doc[starts], place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    new |= (np.arange(len(starts)) - at[np.cumsum(new) - 1]) % GROUP == 0  # so that a group's ends overlap
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(starts)) - 1
    return {
        "at": owner[at],
        "anchor": anchor[at].view(np.int64),
        "p1": place[at],
        "p2": place[end],
        "h1": window_hashes(sym, starts[at], window).view(np.int64),
        "h2": window_hashes(sym, starts[end], window).view(np.int64),
    }


def _keyed(documents: DataFrame) -> DataFrame:
    """ord (doc_id, or a number after all for null), row (hash of id and text) and text."""
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return documents.select(ident.alias("ord"), F.xxhash64(ident, text_or_empty()).alias("row"), "text")


def _group_rows(documents: DataFrame, window: int) -> DataFrame:
    schema = "ord long, row long, anchor long, p1 int, p2 int, h1 long, h2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            got = groups_of([w for *_, w in held], window)
            ids = [np.array([h[i] for h in held], np.int64)[got["at"]] for i in (0, 1)]
            parts = [*ids, got["anchor"], got["p1"].astype(np.int32), got["p2"].astype(np.int32), got["h1"], got["h2"]]
            names = ["ord", "row", "anchor", "p1", "p2", "h1", "h2"]
            return pa.RecordBatch.from_arrays(list(map(pa.array, parts)), names)

        held, n = [], 0
        for batch in batches:
            for i, (ident, row) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                words = words_of(batch.column(2)[i].as_py())
                if len(words) < window:
                    continue
                if held and n + len(words) > BATCH_WORDS:
                    yield out(held)
                    held, n = [], 0
                held.append((ident, row, words))
                n += len(words)
        if held:
            yield out(held)

    return _keyed(documents).mapInArrow(run, schema)


def _open_windows(documents: DataFrame, ranges: DataFrame, window: int) -> DataFrame:
    """(ord, row, anchor, p, h) of every window in the given ranges (row, ranges of anchor, p1, p2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, row, text, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sym = _hashed(words_of(text))
                spans = np.array([(r["anchor"], r["p1"], r["p2"]) for r in some], np.int64)
                count = spans[:, 2] - spans[:, 1] + 1
                at = np.repeat(spans[:, 1] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                h = window_hashes(sym, at, window).view(np.int64)
                parts = [np.full(len(at), ident), np.full(len(at), row), np.repeat(spans[:, 0], count), at.astype(np.int32), h]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, parts)), ["ord", "row", "anchor", "p", "h"])

    joined = _keyed(documents).join(ranges, "row").select("ord", "row", "text", "ranges")
    return joined.mapInArrow(run, "ord long, row long, anchor long, p int, h long")


def repeated_ranges(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, ranges): the places p1..p2 of windows that also start in a document with a smaller id; places
    between p1 and p2 may be left out of the search, as the words they cover are covered already."""
    groups = stored(_group_rows(documents, window), "repeats-groups")
    ends = groups.groupBy("anchor").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi")
    shared = stored(groups.join(ends.select("anchor", "lo"), "anchor"), "repeats-shared")

    seen = shared.select("anchor", "ord", F.explode(F.array("h1", "h2")).alias("h")).groupBy("anchor", "h").agg(F.min("ord").alias("least"))
    one, two = (seen.select("anchor", F.col("h").alias(f"h{i}"), F.col("least").alias(f"least{i}")) for i in (1, 2))
    judged = shared.join(one, ["anchor", "h1"]).join(two, ["anchor", "h2"])
    covered = (F.col("least1") < F.col("ord")) & (F.col("least2") < F.col("ord"))
    judged = stored(judged.select("ord", "row", "anchor", "p1", "p2", "lo", covered.alias("covered")), "repeats-judged")

    undecided = judged.where("not covered and ord > lo").select("anchor").distinct()
    again = judged.join(undecided, "anchor", "left_semi").select("row", "anchor", "p1", "p2").distinct()
    ranges = again.groupBy("row").agg(F.collect_list(F.struct("anchor", "p1", "p2")).alias("ranges"))  # of one document
    windows = stored(_open_windows(documents, ranges, window), "repeats-windows")
    least = windows.groupBy("anchor", "h").agg(F.min("ord").alias("least"), F.max("ord").alias("most")).where("least < most")
    matched = windows.join(least, ["anchor", "h"]).where("least < ord").select("row", F.col("p").alias("p1"), F.col("p").alias("p2"))
    every = judged.where("covered").select("row", "p1", "p2").unionByName(matched).distinct()
    return every.groupBy("row").agg(F.collect_list(F.struct("p1", "p2")).alias("ranges"))


def kept_words(words: list[bytes], ranges, window: int) -> list[bytes]:
    marks = np.zeros(len(words) + 1, np.int64)
    for r in ranges or ():
        marks[r["p1"]] += 1
        marks[r["p2"] + window] -= 1
    gone = np.cumsum(marks)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words


def _with_ranges(documents: DataFrame, window: int, name: str) -> DataFrame:
    row = fresh(documents, "_row")
    found = repeated_ranges(documents, window).withColumnRenamed("row", "_of").withColumnRenamed("ranges", name)
    keyed = documents.withColumn(row, F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), text_or_empty()))
    return keyed.join(found, F.col(row) == F.col("_of"), "left").drop(row, "_of")


def removal_report(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one space), a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = words_of(text)
                kept = kept_words(words, ranges, window)
                rows.append((len(words), len(words) - len(kept), sha256(b" ".join(kept)).hexdigest()))
            n, removed, digest = zip(*rows, strict=True) if rows else ((), (), ())
            more = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *more], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    marked = _with_ranges(documents.select("doc_id", "text"), window, "ranges").select(F.col("doc_id").cast("long"), "text", "ranges")
    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with ``text`` reduced to its kept words, joined by one space, where any were removed."""
    name = fresh(documents, "_ranges")
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, ranges = list(batch.columns[:-1]), batch.column(batch.num_columns - 1).to_pylist()
            texts = columns[at].to_pylist()
            new = [b" ".join(kept_words(words_of(t), r, window)).decode("utf-8", "surrogatepass") if r else t for t, r in zip(texts, ranges, strict=True)]
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return _with_ranges(documents, window, name).select(*documents.columns, name).mapInArrow(run, documents.schema)
