"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) stand for which of a piece BPE (B), counted over a
corpus.

Every text is encoded by both. Byte offsets where tokens of both end cut the text into groups, and each A token of
a group is linked with each B token of it. An id pair's count is the number of documents that hold it linked.

1. Tasks encode documents run by run (``Sizes.run`` code points of text each). A run keeps its documents' pair records, sorted
   A side first and zstd-compressed, and lists each pair once with the number of its documents: copies and
   frequent pairs are one record a run, however many documents hold them. Both are stored.
2. The lists are radix-partitioned by A id and sorted by first pair, which Spark spills to disk as it needs. A
   heap over the open pieces merges them in order, so a pair's count is complete when the merge has passed it and
   an A id's highest count when it has passed the id. Each piece then gets its pairs' counts back.
3. Runs meet their answers, and every document sums over its own links.

A task holds one run, or the open pieces of the merge (one of at most ``Sizes.piece`` pairs per run) and one A id's pairs.

Edge cases. A text that is null or empty, or whose tokens' bytes do not give back the text (B folds some
characters, so U+2581 in a text is one case), has no tokens: zeros and ''. A very long text is a run of its own.
Every row is a document, so repeated rows count once each and a null id is kept. Ties: every pair with an A id's
highest count is a best one. An empty table has no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import stored

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: How a byte-level vocabulary of this kind splits text before it merges (fixed).
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The rank encoder's pattern overflows on longer runs of white space: their texts go to the vocabulary's own library.
BLANKS = 50_000
LONG_BLANK = re.compile(rf"\s{{{BLANKS}}}")
#: Groups with more links than this have their repeated ids put together before they are paired.
WIDE = 4096
#: A pair's number: the A id's low byte (the radix), its high bits, the B id.
RADIX_BITS, A_BITS, B_BITS = 8, 24, 24


@dataclass(frozen=True)
class Sizes:
    """What a task holds: ``run`` code points of text that make a run, ``piece`` pairs in a piece of a run's list,
    ``settle`` pairs that wait before the merge settles them. Results do not depend on them."""

    run: int = 4 << 20
    piece: int = 8192
    settle: int = 1 << 18


# --- the two tokenizers ---------------------------------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes in rising order for U+0100 and on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Side:
    """A tokenizer: ``encode`` gives the ids of each text; ``pieces`` the bytes of each id, ``sizes`` their number."""

    encode: object
    pieces: list[bytes]
    sizes: np.ndarray

    @staticmethod
    def of(encode, pieces: list[bytes]) -> Side:
        return Side(encode, pieces, np.array([len(p) for p in pieces], dtype=np.int64))


@lru_cache(maxsize=2)
def sides(folder: str) -> tuple[Side, Side]:
    """Both tokenizers, read once a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(f"{folder}/{A_FILE}")
    byte_level.encode_special_tokens = True
    alphabet = byte_level_alphabet()
    entries = [""] * byte_level.get_vocab_size()
    for entry, i in byte_level.get_vocab().items():
        entries[i] = entry
    known = [bytes(alphabet.get(c, 0) for c in entry) for entry in entries]
    special = {i for i, token in byte_level.get_added_tokens_decoder().items() if token.special}
    # the same vocabulary as ranks, which is its order of merging, in an encoder that takes a third of the time
    ranked = tiktoken.Encoding(
        A_FILE, pat_str=A_PATTERN, mergeable_ranks={p: i for i, p in enumerate(known) if i not in special}, special_tokens={}
    )

    def encode_a(texts: list[str]) -> list[list[int]]:
        return [
            byte_level.encode(" " + t, add_special_tokens=False).ids if len(t) >= BLANKS and LONG_BLANK.search(t) else ranked.encode_ordinary(" " + t)
            for t in texts
        ]

    a = Side.of(encode_a, known)
    model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
    b = Side.of(
        lambda texts: model.encode(texts, num_threads=1),
        [
            bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ],
    )
    return a, b


# --- one run of documents -------------------------------------------------------------------------------------

def pair_numbers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number per id pair, ordered by radix, then A id, then B id."""
    a = a.astype(np.int64)
    return (((a & 255) << A_BITS | a >> RADIX_BITS) << B_BITS) | b


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, count times."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


@dataclass
class Encoded:
    """The ids of a run's documents on both sides, cut into groups. ``a_ids`` are all documents' A ids in order,
    ``a_first`` where each group starts in them (and the end), ``docs`` the document of each group."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    docs: np.ndarray
    n_docs: int


def encode(texts: list[str | None], a: Side, b: Side) -> Encoded:
    """Encode and group a run's texts; a text that either side does not give back has no tokens."""
    some = [i for i, t in enumerate(texts) if t]
    a_lists, b_lists = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    a_firsts, b_firsts, docs = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    a_at = b_at = 0
    for at in range(0, len(some), 256):
        part = some[at : at + 256]
        chosen = [texts[i] for i in part]
        for i, text, a_ids, b_ids in zip(part, chosen, a.encode(chosen), b.encode(chosen), strict=True):
            want = b" " + text.encode("utf-8", "surrogatepass")
            if b"".join(map(a.pieces.__getitem__, a_ids)) != want or b"".join(map(b.pieces.__getitem__, b_ids)) != want:
                continue
            a_ids, b_ids = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
            a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
            at_b = np.searchsorted(b_ends, a_ends)  # ends rise strictly, and both lists end at the text's end
            common = b_ends[at_b] == a_ends
            a_last, b_last = np.flatnonzero(common), at_b[common]
            a_lists.append(a_ids)
            b_lists.append(b_ids)
            a_firsts.append(np.append(0, a_last[:-1] + 1) + a_at)
            b_firsts.append(np.append(0, b_last[:-1] + 1) + b_at)
            docs.append(np.full(len(a_last), i))
            a_at += len(a_ids)
            b_at += len(b_ids)
    return Encoded(
        np.concatenate(a_lists),
        np.concatenate(b_lists),
        np.append(np.concatenate(a_firsts), a_at).astype(np.int64),
        np.append(np.concatenate(b_firsts), b_at).astype(np.int64),
        np.concatenate(docs),
        len(texts),
    )


def links(run: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair number, links) of a run; a document and pair may come in several parts."""
    n_a, n_b = np.diff(run.a_first), np.diff(run.b_first)
    narrow = n_a * n_b <= WIDE
    a_starts, b_starts = run.a_first[:-1][narrow], run.b_first[:-1][narrow]
    a_n, b_n, docs = n_a[narrow], n_b[narrow], run.docs[narrow]
    a_at = _spread(a_starts, a_n)  # every A token with the B tokens of its group
    times = np.repeat(b_n, a_n)
    b_at = _spread(np.repeat(b_starts, a_n), times)
    parts = [(np.repeat(np.repeat(docs, a_n), times), pair_numbers(np.repeat(run.a_ids[a_at], times), run.b_ids[b_at]), np.ones(len(b_at), dtype=np.int64))]
    for g in np.flatnonzero(~narrow):
        a, a_times = np.unique(run.a_ids[run.a_first[g] : run.a_first[g + 1]], return_counts=True)
        b, b_times = np.unique(run.b_ids[run.b_first[g] : run.b_first[g + 1]], return_counts=True)
        pairs = pair_numbers(np.repeat(a, len(b)), np.tile(b, len(a)))
        parts.append((np.full(len(pairs), run.docs[g]), pairs, np.outer(a_times, b_times).ravel()))
    docs, pairs, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
    return docs, pairs, counts


def pair_records(run: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A run's distinct pairs in order, and its pair-document records by document: (document, which pair, links)."""
    docs, pairs, counts = links(run)
    distinct, which = np.unique(pairs, return_inverse=True)
    both = docs * max(len(distinct), 1) + which
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.diff(both, prepend=-1))
    totals = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, dtype=np.int64)
    return distinct, both[first] // max(len(distinct), 1), both[first] % max(len(distinct), 1), totals


def group_digests(run: Encoded, a: Side, b: Side) -> list[str]:
    """sha256 of each document's groups as text, '' without tokens."""
    n_a, n_b = np.diff(run.a_first), np.diff(run.b_first)
    of_a, of_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    # A tokens of a group come after all earlier B tokens, B tokens after the group's own A tokens
    place_a = np.arange(len(run.a_ids)) + run.b_first[:-1][of_a]
    place_b = np.arange(len(run.b_ids)) + run.a_first[1:][of_b]
    lead_a = (np.arange(len(run.a_ids)) == run.a_first[:-1][of_a]).astype(np.int64)
    lead_b = (np.arange(len(run.b_ids)) == run.b_first[:-1][of_b]).astype(np.int64)
    width_a, width_b = len(a.pieces), len(b.pieces)
    words = np.array([f"{sign}{i}" for sign, n in ((",", width_a), (";", width_a), (",", width_b), ("|", width_b)) for i in range(n)], dtype=object)
    token = np.empty(len(run.a_ids) + len(run.b_ids), dtype=np.int64)
    token[place_a] = run.a_ids + lead_a * width_a
    token[place_b] = run.b_ids + lead_b * width_b + 2 * width_a
    ends = np.searchsorted(run.docs, np.arange(run.n_docs + 1))  # groups are in document order
    cuts = (run.a_first + run.b_first)[ends].tolist()
    return [sha256("".join(words[token[lo:hi]].tolist())[1:].encode()).hexdigest() if hi > lo else "" for lo, hi in zip(cuts, cuts[1:], strict=False)]


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of equal length as zstd, each array at the width it needs."""
    out = []
    for x in arrays:
        width = next(w for w in (1, 2, 4, 8) if x.size == 0 or int(x.max()) < 1 << (8 * w - 1))
        planes = np.ascontiguousarray(x.astype(f"<i{width}")).view(np.uint8).reshape(-1, width)
        out.append(np.uint8(width).tobytes() + planes.T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(len(arrays[0]).to_bytes(8, "little") + b"".join(out))


def unpacked(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``packed``."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    while at < len(raw):
        width = raw[at]
        planes = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<i{width}").ravel().astype(np.int64))
        at += 1 + n * width
    return out


def pieces(distinct: np.ndarray, counts: np.ndarray, size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """A run's list cut at radix changes and every ``size`` pairs: radix, piece number, first pair, packed list."""
    radix = distinct >> (A_BITS + B_BITS)
    starts = np.flatnonzero(np.diff(radix, prepend=-1))
    number = 0
    for lo, hi in zip(starts, np.append(starts, len(distinct))[1:], strict=True):
        for at in range(lo, hi, size):
            keys = distinct[at : min(at + size, hi)]
            yield int(radix[lo]), number, int(keys[0]), packed(np.diff(keys, prepend=keys[0]), counts[at : at + len(keys)])
            number += 1


RUNS = "run long, radix int, piece int, first long, pairs binary, bounds binary, digests array<string>, ids binary, records binary"
RUN_SCHEMA = pa.schema(
    [
        ("run", pa.int64()), ("radix", pa.int32()), ("piece", pa.int32()), ("first", pa.int64()), ("pairs", pa.binary()),
        ("bounds", pa.binary()), ("digests", pa.list_(pa.string())), ("ids", pa.binary()), ("records", pa.binary()),
    ]
)


def _run_rows(number: int, ids: pa.Array, texts: list[str | None], folder: str, size: int) -> list[tuple]:
    """A run as rows: one with its documents (piece -1), one for each piece of its list of pairs."""
    a, b = sides(folder)
    run = encode(texts, a, b)
    distinct, docs, which, counts = pair_records(run)
    per_group = [np.bincount(run.docs, weights=w, minlength=run.n_docs).astype(np.int64) for w in (np.diff(run.a_first), np.diff(run.b_first), np.ones(len(run.docs)))]
    per_doc = np.bincount(docs, minlength=run.n_docs)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as w:
        w.write_batch(pa.record_batch([ids], names=["id"]))
    kept = (number, None, -1, None, None, packed(*per_group, per_doc), group_digests(run, a, b), sink.getvalue().to_pybytes(), packed(which, counts))
    listed = [(number, radix, piece, first, blob, None, None, None, None) for radix, piece, first, blob in pieces(distinct, np.bincount(which, minlength=len(distinct)), size)]
    return [kept, *listed]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), RUN_SCHEMA, strict=True)], schema=RUN_SCHEMA)


def encoded_runs(docs: DataFrame, id_column: str, text_column: str, folder: str, sizes: Sizes) -> DataFrame:
    """The documents as stored runs."""

    def encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # unique within the stored table
        ids, texts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, texts, size, number
            batch = _as_batch(_run_rows(number, pa.concat_arrays(ids), texts, folder, sizes.piece))
            ids, texts, size, number = [], [], 0, number + 1
            return batch

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if size and size + len(text or "") > sizes.run:
                    yield flush()
                ids.append(batch.column(0).slice(i, 1))
                texts.append(text)
                size += len(text or "") + 1
        if texts:
            yield flush()

    return stored(docs.select(id_column, text_column).mapInArrow(encode_task, RUNS), "alignment-runs")


# --- the merge ------------------------------------------------------------------------------------------------

@dataclass
class Piece:
    """An open piece: its pairs, their documents in its run, the counts settled so far."""

    run: int
    piece: int
    pairs: np.ndarray
    counts: np.ndarray
    total: np.ndarray
    best: np.ndarray
    at: int = 0


class Merge:
    """A k-way merge of sorted pieces that come in order of their first pair. A heap holds the open pieces by
    their next pair. What lies below ``bound`` (always the start of an A id) is complete."""

    def __init__(self) -> None:
        self.heap: list[tuple[int, int, Piece]] = []
        self.waiting = 0
        self.seq = 0

    def add(self, run: int, piece: int, first: int, blob: bytes) -> None:
        steps, counts = unpacked(blob)
        pairs = np.cumsum(steps) + first
        heapq.heappush(self.heap, (first, self.seq, Piece(run, piece, pairs, counts, np.zeros_like(counts), np.zeros_like(counts))))
        self.seq += 1
        self.waiting += len(pairs)

    def settle(self, bound: int) -> Iterator[Piece]:
        """Settle all pairs below ``bound``; gives the pieces that are done."""
        taken: list[tuple[Piece, int, int]] = []
        while self.heap and self.heap[0][0] < bound:
            _, seq, p = heapq.heappop(self.heap)
            end = int(np.searchsorted(p.pairs, bound))
            taken.append((p, p.at, end))
            p.at = end
            if end < len(p.pairs):
                heapq.heappush(self.heap, (int(p.pairs[end]), seq, p))
        if not taken:
            return
        pairs, which = np.unique(np.concatenate([p.pairs[lo:hi] for p, lo, hi in taken]), return_inverse=True)
        totals = np.bincount(which, weights=np.concatenate([p.counts[lo:hi] for p, lo, hi in taken])).astype(np.int64)
        starts = np.flatnonzero(np.diff(pairs >> B_BITS, prepend=-1))  # pairs of one A id lie side by side
        highest = np.repeat(np.maximum.reduceat(totals, starts), np.diff(np.append(starts, len(pairs))))
        best = (totals == highest).astype(np.int64)
        at = 0
        for p, lo, hi in taken:
            mine = which[at : at + hi - lo]
            p.total[lo:hi], p.best[lo:hi] = totals[mine], best[mine]
            at += hi - lo
            self.waiting -= hi - lo
            if hi == len(p.pairs):
                yield p


ANSWERS = "run long, piece int, counts binary"


def merged_counts(runs: DataFrame, sizes: Sizes) -> DataFrame:
    """For every piece, its pairs' counts over all documents and whether each is its A id's highest."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Merge()

        def answers(done: list[Piece]) -> pa.RecordBatch:
            columns = [[p.run for p in done], [p.piece for p in done], [packed(p.total, p.best) for p in done]]
            return pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], names=["run", "piece", "counts"])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("run", "piece", "first", "pairs")), strict=True)
            for run, piece, first, blob in rows:
                if state.waiting > sizes.settle:
                    if done := list(state.settle(first >> B_BITS << B_BITS)):
                        yield answers(done)
                state.add(run, piece, first, blob)
        if done := list(state.settle(1 << 62)):
            yield answers(done)

    lists = runs.where(F.col("piece") >= 0).select("radix", "run", "piece", "first", "pairs")
    sorted_lists = lists.repartition("radix").sortWithinPartitions("first", "run")  # the radix leads the pair's number
    return sorted_lists.select("run", "piece", "first", "pairs").mapInArrow(merge, ANSWERS)


# --- the operator ---------------------------------------------------------------------------------------------

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folder: str = TOKENIZERS, sizes: Sizes = Sizes()
) -> DataFrame:
    """Per document its id, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, the links that are their A id's
    most frequent (``n_best``), the links' counts added up (``count_sum``) and ``groups_sha256``.

    ``folder`` holds both vocabularies on every executor."""
    runs = encoded_runs(docs, id_column, text_column, folder, sizes)
    id_type = docs.schema[id_column].dataType.simpleString()
    kept = runs.where(F.col("piece") < 0).select("run", "bounds", "digests", "ids", "records")

    def per_document(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        order = np.argsort(right.column("piece").to_numpy())
        blobs = right.column("counts").to_pylist()
        answers = [unpacked(blobs[i]) for i in order]
        none = np.zeros(0, dtype=np.int64)
        total = np.concatenate([none, *(x[0] for x in answers)])
        best = np.concatenate([none, *(x[1] for x in answers)])
        n_a, n_b, n_groups, per_doc = unpacked(row["bounds"])
        which, counts = unpacked(row["records"])
        owner = np.repeat(np.arange(len(per_doc)), per_doc)

        def summed(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(per_doc), dtype=np.int64)
            np.add.at(out, owner, values)
            return out

        figures = (n_a, n_b, n_groups, summed(counts), summed(counts * best[which]), summed(counts * total[which]))
        ids = pa.ipc.open_stream(row["ids"]).read_all().column(0)
        return pa.table([ids, *(pa.array(f) for f in figures), pa.array(row["digests"], pa.string())], names=["id", *FIGURES, "groups_sha256"])

    found = kept.groupBy("run").cogroup(merged_counts(runs, sizes).groupBy("run")).applyInArrow(
        per_document, f"id {id_type}, {', '.join(f'{c} long' for c in FIGURES)}, groups_sha256 string"
    )
    return found.withColumnRenamed("id", id_column)


def pair_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folder: str = TOKENIZERS, sizes: Sizes = Sizes()
) -> DataFrame:
    """The id pairs themselves: ``a_id``, ``b_id``, the ``documents`` that hold them linked, and whether that is the
    A id's highest count (``best``)."""
    runs = encoded_runs(docs, id_column, text_column, folder, sizes)
    lists = runs.where(F.col("piece") >= 0).select("run", "piece", "first", "pairs")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, blob, counts in zip(*(batch.column(c).to_pylist() for c in ("first", "pairs", "counts")), strict=True):
                pairs = np.cumsum(unpacked(blob)[0]) + first
                total, best = unpacked(counts)
                a = pairs >> B_BITS
                a = (a & ((1 << A_BITS) - 1)) << RADIX_BITS | a >> A_BITS
                yield pa.record_batch([pa.array(a), pa.array(pairs & ((1 << B_BITS) - 1)), pa.array(total), pa.array(best == 1)], names=["a_id", "b_id", "documents", "best"])

    answered = lists.join(merged_counts(runs, sizes), ["run", "piece"])
    return answered.select("first", "pairs", "counts").mapInArrow(listed, "a_id long, b_id long, documents long, best boolean").distinct()
