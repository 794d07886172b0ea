"""Cross-tokenizer alignment: groups, links and counts against plain loops over the tokenizers themselves."""

import json
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadflow.llm import alignment
from roadflow.llm.common import table

HARD = [
    "", None, " ", "a", "Hello world", "  two  spaces\t\ttabs\n\n\nlines ", "naïve café – “quotes”", "漢字かな交じり文", "🙂🙂👩‍👩‍👧",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ lower block", "x" * 3000, " " * 2000, "=" * 1001 + "\n" * 77, " ​﻿", "İstanbul ǅ ﬁ",
    "123456789 3.14159 1,000,000", "Ünïcödé " * 50, "def f(x):\n    return x**2\n", "\x00\x01\x7f", "가나다 라마바",
]


def byte_of_character():
    """The byte-level alphabet, written out from its definition."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(keep)))}


def brute(texts):
    """Result columns of every text, by loops."""
    a_tok = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")
    byte = byte_of_character()
    entries = {i: bytes(byte[c] for c in e) for e, i in json.load(open(f"{alignment.TOKENIZERS}/byte_bpe_50k.json"))["model"]["vocab"].items() if not e.startswith("<|")}
    linked = []
    for text in texts:
        groups = []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            a_bytes = [entries[i] for i in a]
            names = [b_tok.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names, strict=True)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                i = j = at_a = at_b = 0
                group = ([], [])
                while i < len(a) or j < len(b):
                    if at_a <= at_b:
                        group[0].append(a[i])
                        at_a += len(a_bytes[i])
                        i += 1
                    else:
                        group[1].append(b[j])
                        at_b += len(b_bytes[j])
                        j += 1
                    if at_a == at_b:
                        groups.append(group)
                        group = ([], [])
        linked.append(groups)
    counts, per_doc = Counter(), []
    for groups in linked:
        pairs = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        per_doc.append(pairs)
        counts.update(pairs.keys())
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for groups, pairs in zip(linked, per_doc, strict=True):
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        best = sum(m for p, m in pairs.items() if counts[p] == highest[p[0]])
        total = sum(m * counts[p] for p, m in pairs.items())
        sizes = [sum(len(g[s]) for g in groups) for s in (0, 1)]
        rows.append((*sizes, len(groups), sum(pairs.values()), best, total, sha256(text.encode()).hexdigest() if groups else ""))
    return rows, {(x, y): (n, n == highest[x]) for (x, y), n in counts.items()}


def as_rows(found):
    return {r.doc_id: tuple(r[c] for c in (*alignment.FIGURES, "groups_sha256")) for r in found.collect()}


def test_whole_table_against_loops(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    want, _ = brute([r.text for r in rows])
    assert as_rows(alignment.align(docs)) == {r.doc_id: w for r, w in zip(rows, want, strict=True)}


@pytest.mark.parametrize("sizes", [alignment.Sizes(), alignment.Sizes(run=60, piece=3, settle=5)])
def test_hard_texts_copies_and_small_pieces(spark, sizes):
    texts = HARD + [HARD[4]] * 40 + HARD[7:9] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for name in ("run", "piece", "first", "id", "n_a", "counts"):
        docs = docs.withColumn(name, F.lit("taken"))
    want, pairs = brute(texts)
    assert as_rows(alignment.align(docs, sizes=sizes)) == dict(enumerate(want))
    got = {(r.a_id, r.b_id): (r.documents, r.best) for r in alignment.pair_counts(docs, sizes=sizes).collect()}
    assert got == pairs


def test_merge_in_small_pieces_is_a_count():
    rng = random.Random(4)
    runs = {}
    for run in range(30):
        pairs = {(rng.choice([1, 2, 3, 257, 300, 513]), rng.randrange(40)): rng.randrange(1, 9) for _ in range(60)}
        keys = alignment.pair_numbers(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        order = np.argsort(keys)
        runs[run] = (keys[order], np.array(list(pairs.values()))[order])
    total = Counter()
    for keys, counts in runs.values():
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            total[k] += c
    highest = defaultdict(int)
    for k, c in total.items():
        highest[k >> alignment.B_BITS] = max(highest[k >> alignment.B_BITS], c)
    rows = sorted((first, run, piece, blob) for run, (keys, counts) in runs.items() for _, piece, first, blob in alignment.pieces(keys, counts, 5))
    merge, done = alignment.Merge(), []
    for first, run, piece, blob in rows:
        if merge.waiting > 20:
            done += merge.settle(first >> alignment.B_BITS << alignment.B_BITS)
        merge.add(run, piece, first, blob)
    done += merge.settle(1 << 62)
    assert not merge.heap and not merge.waiting and len(done) == len(rows)
    for p in done:
        assert p.total.tolist() == [total[k] for k in p.pairs.tolist()]
        assert p.best.tolist() == [int(total[k] == highest[k >> alignment.B_BITS]) for k in p.pairs.tolist()]


def test_wide_groups_are_paired_by_distinct_ids(monkeypatch):
    run = alignment.Encoded(np.array([5, 5, 6, 7]), np.array([1, 2, 1, 9]), np.array([0, 3, 4]), np.array([0, 3, 4]), np.array([0, 2]), 3)
    want = alignment.pair_records(run)
    monkeypatch.setattr(alignment, "WIDE", 0)
    for x, y in zip(want, alignment.pair_records(run), strict=True):
        assert x.tolist() == y.tolist()
    assert want[3].sum() == 3 * 3 + 1


def test_rank_encoder_is_the_vocabulary():
    """Every Unicode plane's blocks in several contexts, random bytes of text, and runs of blanks beyond the limit."""
    library = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    a, _ = alignment.sides(alignment.TOKENIZERS)
    points = [c for c in (*range(0, 0x3100), *range(0x3100, 0x110000, 257)) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)}  {chr(c)}\n" for c in points[at : at + 64]) for at in range(0, len(points), 64)]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab'st  \n\t1é漢🙂_-.") for _ in range(300)) for _ in range(200)]
    texts += [" " * n + "x" for n in (alignment.BLANKS - 1, alignment.BLANKS, 1_000_000)]
    assert a.encode(texts) == [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1000):
        arrays = [rng.integers(0, top, n) for top in (2, 300, 70000, 1 << 60)]
        assert [x.tolist() for x in alignment.unpacked(alignment.packed(*arrays))] == [x.tolist() for x in arrays]


def test_empty_table_and_nulls(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty).collect() == []
    docs = spark.createDataFrame([(None, "same text"), (1, "same text"), (1, "same text"), (2, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in alignment.align(docs).select(F.coalesce("doc_id", F.lit(-1)), "n_links", "n_best", "count_sum").collect())
    n = got[0][1]
    assert got == [(-1, n, n, 3 * n), (1, n, n, 3 * n), (1, n, n, 3 * n), (2, 0, 0, 0)]
