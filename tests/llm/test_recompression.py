"""Repeated windows against a brute-force search over planted and random texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflow.llm import recompression

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    """(n_words, n_removed, sha256 of the kept) of each row."""
    order = lambda i: (i is None, i)
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words, strict=True):
        for p in range(len(w) - k + 1):
            g = tuple(w[p : p + k])
            if g not in least or order(i) < order(least[g]):
                least[g] = i
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(w) - k + 1):
            if order(least[tuple(w[p : p + k])]) < order(i):
                gone |= set(range(p, p + k))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def planted(rng, n, vocab, longest):
    some = lambda m: [rng.choice(vocab) for _ in range(m)]
    shared = [some(rng.randrange(5, 2 * longest)) for _ in range(6)] + [["a"] * longest, ["a", "b"] * longest, ["x"] + ["a"] * 3 * longest]
    rows = []
    for i in range(n):
        parts = [rng.choice([rng.choice(shared), some(rng.randrange(longest))]) for _ in range(rng.randrange(5))]
        if rows and rng.random() < 0.3:  # a near copy
            text = WORD.findall(rng.choice(rows)[1] or "")
            if text:
                text[rng.randrange(len(text))] = "edit"
            parts = [text]
        rows.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "\n", "\t  "]).join(x for p in parts for x in p)))
    return rows


@pytest.mark.parametrize(("k", "seed"), [(50, 1), (50, 2), (6, 3), (12, 4)])
def test_against_brute_force(spark, k, seed):
    rng = random.Random(seed)
    rows = planted(rng, 120, ["a", "b", "c", "é", "ü x", "w1", "w2", "w3"] + [f"v{i}" for i in range(20 if seed % 2 else 2000)], 2 * k)
    rows += [(1, None), (2, ""), (None, None), rows[0], rows[0], (500, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("ranges", F.lit(0)).withColumn("ord", F.lit(1))
    got = sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in recompression.removal_report(docs, k).collect())))
    want = sorted(str((i, *b)) for (i, _), b in zip(rows, brute(rows, k), strict=True))
    assert got == want
    kept = recompression.without_repeats(docs, k)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(7)
    for vocab in (2, 3, 1000):
        inside = rng.integers(1, vocab + 1, 50).astype(np.uint64)
        seen = set()
        for _ in range(60):
            left, right = (rng.integers(1, vocab + 1, n).astype(np.uint64) for n in rng.integers(0, 40, 2))
            sym = np.concatenate([left, inside, right])
            seen.add(int(recompression.anchors(sym, np.zeros(len(sym), int), np.array([len(left)]), 50)[0]))
        assert len(seen) == 1


def test_symbols_do_not_cross_documents():
    a = np.arange(1, 61, dtype=np.uint64)
    both = np.concatenate([a, a])
    doc = np.repeat([0, 1], 60)
    starts = np.concatenate([np.arange(11), 60 + np.arange(11)])
    got = recompression.anchors(both, doc, starts, 50)
    assert (got[:11] == got[11:]).all()


def test_empty(spark):
    assert recompression.removal_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
