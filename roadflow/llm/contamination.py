"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Texts are normalised to lower-case words (runs of ASCII letters and digits and of anything beyond ASCII).
Every ``window`` consecutive words of an item are one pattern, an item of fewer words is one pattern. The
automaton holds all of them as sequences of word numbers (a state for each word, not for each byte) and reads
each document once; its hits are mapped back to code-point offsets of the original text.

The items are a stated query set. They are read in blocks whose automaton takes at most ``block_bytes``
(normally one block; ``automaton_bytes`` bounds it from the items' words), so what a task holds has a fixed size
however many items there are; only a single item may exceed it. With several blocks the documents are read once
for each, and each pass adds to the hits of the one before.

Defined results: a null text has no words; an empty item matches nothing; a null ``item_id`` is named
``null``; repeated items count once per id; repeated documents are judged row by row; an empty table of documents gives
no rows, one of items no hits; a very long text takes time and memory in proportion to its length; further columns are
kept as they are unless they have the name of a result column, in which case the result replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.llm.common import stored

WINDOW = 10
BLOCK_BYTES = 400 << 20
#: Followers of a state at most.
_BASE = 64
#: Bytes that a state, a pattern and a word take at most: measured over random items (``test_automaton_stays_in_its_bound``).
STATE_BYTES, PATTERN_BYTES, WORD_BYTES = 48, 200, 200

#: ASCII to what separates words (a space) or to itself in lower case; other bytes of UTF-8 stay.
_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32
    for c in range(256)
)

PAIRS = "array<struct<first:long,last:long>>"
RESULT = f"n_words long, item_ids array<string>, hit_words {PAIRS}, spans {PAIRS}"


def folded_words(text: str | None) -> list[bytes]:
    """The text's words in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: list, window: int) -> set[tuple]:
    """Every ``window`` consecutive words, or all of fewer."""
    if not words:
        return set()
    return {tuple(words[i : i + window]) for i in range(max(len(words) - window, 0) + 1)}


def fold(text: str | None) -> bytes:
    """The text's words between single spaces, with a space at either end; empty without words."""
    words = folded_words(text)
    return b" " + b" ".join(words) + b" " if words else b""


def item_patterns(item: str | None, window: int) -> set[bytes]:
    """The windows of an item as they stand in a folded text."""
    return {b" " + b" ".join(p) + b" " for p in windows_of(folded_words(item), window)}


def letters(n_words: int) -> int:
    """Letters that write every number up to ``n_words``."""
    n = 1
    while _BASE**n <= n_words:
        n += 1
    return n


def automaton_size(n_words: int, window: int) -> np.ndarray:
    """(words, patterns, words of patterns) that an item of so many words brings."""
    patterns = max(n_words - window, 0) + 1 if n_words else 0
    return np.array([n_words, patterns, patterns * min(n_words, window)])


def automaton_bytes(size: np.ndarray) -> int:
    """At most what an automaton takes, from the sum of the sizes of its items."""
    words, patterns, states = map(int, size)
    return states * letters(words) * STATE_BYTES + patterns * PATTERN_BYTES + words * WORD_BYTES


class PatternAutomaton:
    """All patterns of a block of items, over numbers of words; words that no item has are 0.

    A number is written in as many letters as the block's largest needs, so that a state has ``_BASE`` followers
    at most (they are searched one after the other); first letters differ from the rest, so that hits begin at words.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        import ahocorasick

        number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], tuple[str, ...]] = {}
        for item_id, text in items:
            numbers = [number.setdefault(w, len(number) + 1) for w in folded_words(text)]
            for p in windows_of(numbers, window):
                ids = owners.get(p, ())
                owners[p] = ids if item_id in ids else (*ids, item_id)
        self.letters = letters(len(number))
        self.unknown = self._written(0)
        self.written = {w: self._written(n) for w, n in number.items()}
        by_number = ["", *self.written.values()]  # numbers were given in this order
        self.found = ahocorasick.Automaton()
        while owners:  # moved, not copied
            p, ids = owners.popitem()
            self.found.add_word("".join([by_number[n] for n in p]), (len(p), ids))
        if len(self.found):
            self.found.make_automaton()

    def _written(self, n: int) -> str:
        digits = [n // _BASE**k % _BASE for k in range(self.letters)]
        return "".join(chr(d + (_BASE if k else 0)) for k, d in enumerate(digits))

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, word after the last, item ids) of every occurrence."""
        if words and len(self.found):
            for end, (length, ids) in self.found.iter("".join(map(self.written.get, words, repeat(self.unknown)))):
                last = (end + 1) // self.letters
                yield last - length, last, ids


@lru_cache(maxsize=1)
def _automaton(items: Broadcast, window: int) -> PatternAutomaton:
    return PatternAutomaton(items.value, window)


def _runs(hit: np.ndarray) -> np.ndarray:
    """(first, last + 1) of each stretch of true values."""
    edges = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return np.stack((np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)), axis=1)


def original_spans(text: str, words: np.ndarray) -> np.ndarray:
    """Word ranges of the folded text as code-point ranges of the original."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = _runs(np.frombuffer(_FOLD, np.uint8)[raw] != 32)
    before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return np.stack((before[at[words[:, 0], 0]], before[at[words[:, 1] - 1, 1]]), axis=1)


def scan(text: str | None, automaton: PatternAutomaton, known: list[tuple[int, int]], known_ids: list[str]) -> tuple[int, list[str], np.ndarray]:
    """Words, ids of the items with a window in the text, and the hit word ranges, joined with those known."""
    words = folded_words(text)
    ids, marks = set(known_ids), np.zeros(len(words) + 1, np.int64)
    for first, last, owners in automaton.hits(words):
        ids.update(owners)
        marks[first] += 1
        marks[last] -= 1
    for first, last in known:
        marks[first] += 1
        marks[last] -= 1
    return len(words), sorted(ids), _runs(np.cumsum(marks)[:-1] > 0)


def item_blocks(benchmark: DataFrame, block_bytes: int, window: int = WINDOW) -> Iterator[list[tuple[str, str]]]:
    """The items, in lists whose automaton takes ``block_bytes`` at most (or of one item); one list is on the
    driver at a time."""
    block, size = [], automaton_size(0, window)
    ident = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    for r in benchmark.where("text is not null").select(ident.alias("i"), F.col("text").alias("t")).toLocalIterator():
        more = automaton_size(len(folded_words(r.t)), window)
        if block and automaton_bytes(size + more) > block_bytes:
            yield block
            block, size = [], automaton_size(0, window)
        block.append((r.i, r.t))
        size = size + more
    yield block


def _scanned(items: Broadcast, window: int):
    pairs = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    as_pairs = lambda rows: pa.array([[{"first": int(a), "last": int(b)} for a, b in x] for x in rows], pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(items, window)
        for batch in batches:
            column = lambda name: batch.column(batch.schema.names.index(name)).to_pylist()  # noqa: E731, B023
            texts = column("text")
            known = [[(p["first"], p["last"]) for p in x] for x in column("hit_words")]
            found = [scan(t, automaton, k, i) for t, k, i in zip(texts, known, column("item_ids"), strict=True)]
            spans = [original_spans(t, f[2]) if len(f[2]) else [] for t, f in zip(texts, found, strict=True)]
            new = {
                "n_words": pa.array([f[0] for f in found], pa.int64()),
                "item_ids": pa.array([f[1] for f in found], pa.list_(pa.string())),
                "hit_words": as_pairs(f[2] for f in found),
                "spans": as_pairs(spans),
            }
            yield pa.RecordBatch.from_arrays([new.get(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True)], batch.schema.names)

    return run


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``documents`` with n_words, n_hit, item_ids (sorted as strings), the hit word ranges and their spans.

    ``spans`` are code points of the original text, end exclusive; so are the word numbers of ``hit_words``.
    """
    spark = documents.sparkSession
    out = documents.drop("n_words", "n_hit", "item_ids", "hit_words", "spans").withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "item_ids": F.array().cast("array<string>"),
            "hit_words": F.array().cast(PAIRS),
            "spans": F.array().cast(PAIRS),
        }
    )
    for k, items in enumerate(item_blocks(benchmark, block_bytes, window)):
        out = stored(out, "contamination") if k else out  # so that a task holds one automaton at a time
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
        out = out.mapInArrow(_scanned(spark.sparkContext.broadcast(items), window), schema)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"])
    return out.withColumn("n_hit", n_hit)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any window of a benchmark item, with their columns."""
    return find_contamination(documents, benchmark, window).where("n_hit = 0").select(*documents.columns)
