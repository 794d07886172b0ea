"""Stupid-backoff language-model scores of all documents from n-gram counts of all documents.

    S(w | context) = c(context w) / c(context)       if c(context w) >= MIN_COUNT
                   = BACKOFF * S(w | shorter context) otherwise;  S(w) = c(w) / T

All n-grams count (``MIN_COUNT`` is 1): as the texts scored are the texts counted, a word with two words before it
has its trigram's score, and the first words of a text have their bigram's and unigram's. A higher ``min_count``
backs off from rarer n-grams.

A document's score is the mean of ln S over its words, each with up to ``order - 1`` words before it.

The join of every exploded n-gram with the count tables would shuffle each word's n-grams with their document
several times. Instead every task packs its documents into blocks of about ``BLOCK_CHARS`` characters, one
stored row each, and a block's n-grams are joined once each:

1. a block lists its distinct n-gram hashes of all orders with their counts, cut into hash ranges;
2. a hash range adds up the lists of all blocks: the count table of that range (n-grams of all orders, the
   table partitioned by hash), and answers every list with the total counts, in the list's order;
3. a block, its texts and its answers meet, and each document sums its words' scores.

Blocks and ranges have a fixed size: nothing grows in a task with the input, and a word in a third of all texts
is one entry of a list. Lists travel as compressed byte planes of sorted differences, some ranges a batch.
n-grams are named by 64-bit hashes.

Defined results: a null or blank text has 0 words and a null score; repeated rows count as often as they
occur; a null doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import stored, text_or_empty

ORDER = 3
MIN_COUNT = 1
BACKOFF = 0.4
BLOCK_CHARS = 8 << 20
RANGE_ENTRIES = 1 << 20
BATCH_LISTS = 64

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def planes(values: np.ndarray) -> bytes:
    """uint64 numbers as eight planes of bytes, lowest first, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed(ascending: np.ndarray) -> bytes:
    return planes(np.diff(ascending, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data), dtype=np.uint64)


def _words(z: bytes, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts of a block, and how many words each text has."""
    data, at, hashes = zstandard.ZstdDecompressor().decompressobj().decompress(z), 0, []
    for n in lengths:
        words = data[at : at + n].split()
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at += n
    return np.concatenate(hashes), np.array([len(h) for h in hashes], np.int64)


def ngrams(word: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The hashes of the n-grams of all texts, one order n after the other, and for each n which words end one."""
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ends = [place >= n - 1 for n in range(1, order + 1)]
    del place
    grams = [gram := _mix(word)]  # gram: of the n-gram that ends at a word, if one does
    for n in range(2, order + 1):
        gram = np.append(gram[:1], _mix(gram[:-1] * _A + word[1:] + np.uint64(n)))
        grams.append(gram[ends[n - 1]])
    return np.concatenate(grams), ends


def _cuts(ascending: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of the hashes' upper ``bits`` begins, and the end."""
    if bits == 0:
        return np.array([0, len(ascending)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(ascending, edges), [len(ascending)]))


def _lists(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, z in zip(*(batch.column(c) for c in ("block", "lengths", "z")), strict=True):
                found, _ = ngrams(*_words(z.as_py(), lengths.as_py()), order)
                found.sort()
                first = np.flatnonzero(np.diff(found, prepend=~found[:1]))
                n = np.diff(first, append=len(found))
                found = found[first]
                cuts = _cuts(found, bits)
                some = [p for p in range(len(cuts) - 1) if cuts[p] < cuts[p + 1]]
                for i in range(0, len(some), BATCH_LISTS):
                    parts = [slice(cuts[p], cuts[p + 1]) for p in some[i : i + BATCH_LISTS]]
                    yield pa.RecordBatch.from_pydict({
                        "range": pa.array(some[i : i + BATCH_LISTS], pa.int32()),
                        "block": pa.array([block.as_py()] * len(parts), pa.int64()),
                        "hashes": pa.array([packed(found[s]) for s in parts], pa.binary()),
                        "counts": pa.array([planes(n[s]) for s in parts], pa.binary()),
                    })

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Answers to the lists of one hash range, from the counts that they add up to."""
    lists = [unpacked(x) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([numbers(x) for x in table.column("counts").to_pylist()])
    known, at = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.zeros(len(known), np.uint64)
    np.add.at(total, at, counts)
    ends = np.cumsum([len(x) for x in lists])
    answers = [planes(total[at[e - len(x) : e]]) for x, e in zip(lists, ends, strict=True)]
    return pa.table({"block": table.column("block"), "range": table.column("range"), "totals": pa.array(answers, pa.binary())})


def _counts(grams: np.ndarray, totals: list[bytes]) -> np.ndarray:
    """The total of each n-gram, from the totals of the distinct ones in ascending order."""
    by = np.argsort(grams)
    new = np.diff(grams[by], prepend=~grams[by[:1]]) != 0
    rank = np.cumsum(new, dtype=np.int32) - 1
    total = np.concatenate([np.zeros(0, np.uint64), *map(numbers, totals)]).astype(np.float64)
    out = np.empty(len(grams))
    out[by] = total[rank]
    return out


def _scores(order: int, min_count: int, total_words: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, lengths, z = (docs.column(c)[0] for c in ("doc_ids", "lengths", "z"))
        word, sizes = _words(z.as_py(), lengths.as_py())
        grams, ends = ngrams(word, sizes, order)
        del word
        parts = sorted(zip(answers.column("range").to_pylist(), answers.column("totals").to_pylist(), strict=True))
        counts = np.split(_counts(grams, [x for _, x in parts]), np.cumsum([e.sum() for e in ends])[:-1])
        score = np.log(counts[0] / max(total_words, 1))
        used = np.ones(len(score), np.int8)  # the order that gave a word's score
        context = counts[0]
        for n in range(2, order + 1):
            here, c = np.flatnonzero(ends[n - 1]), counts[n - 1]
            seen = c >= min_count
            score[here] = np.where(seen, np.log(c / np.maximum(context[here - 1], 1)), score[here] + np.log(BACKOFF))
            used[here] = np.where(seen, n, used[here])
            context[here] = c
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(owner, score, len(sizes))
        backed = np.bincount(owner, used == 1, len(sizes)).astype(np.int64)
        mean = [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist(), strict=True)]
        return pa.table({
            "doc_id": pa.array(ids.as_py(), pa.int64()),
            "n_words": pa.array(sizes, pa.int64()),
            "n_unigram": pa.array(backed, pa.int64()),
            "score": pa.array(mean, pa.float64()),
        })

    return run


def _blocks(documents: DataFrame, block_chars: int) -> DataFrame:
    """(block, doc_ids, lengths, z): consecutive documents, and their texts' bytes, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # a task has a partition's blocks to itself

        def block() -> pa.RecordBatch:
            row = [[number], [ids], [lengths], [b"".join([*parts, squeeze.flush()])]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, kinds, strict=True)], schema=kinds)

        kinds = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("z", pa.binary())])
        ids, lengths, parts, chars, squeeze = [], [], [], 0, zstandard.ZstdCompressor(level=3).compressobj()
        for batch in batches:
            for i, t in zip(*batch.columns, strict=True):
                text = (t.as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(i.as_py())
                lengths.append(len(text))
                parts.append(squeeze.compress(text))
                chars += len(text)
                if chars >= block_chars:
                    yield block()
                    number += 1
                    ids, lengths, parts, chars, squeeze = [], [], [], 0, zstandard.ZstdCompressor(level=3).compressobj()
        if ids:
            yield block()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, "block long, doc_ids array<long>, lengths array<long>, z binary"), "ngram-blocks")


def score(documents: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, block_chars: int = BLOCK_CHARS, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """doc_id, n_words, n_unigram (words scored without context) and score, a row per document."""
    from roadflow.llm.mixing import word_count

    words = documents.agg(F.sum(word_count(text_or_empty())).alias("words")).first().words or 0
    bits = max(0, int(order * words / range_entries).bit_length())
    blocks = _blocks(documents, block_chars)
    lists = blocks.mapInArrow(_lists(order, bits), "range int, block long, hashes binary, counts binary")
    answers = stored(lists.groupBy("range").applyInArrow(_totals, "block long, range int, totals binary"), "ngram-totals", tidy=True)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(order, min_count, words), "doc_id long, n_words long, n_unigram long, score double")
