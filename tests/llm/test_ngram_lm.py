"""Stupid backoff against a plain computation, over several blocks and hash ranges."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from roadflow.llm import ngram_lm
from roadflow.llm.common import TIDY


def words(t):
    return [w for w in "".join(" " if c in "\t\n\x0b\f\r" else c for c in t or "").split(" ") if w]


def brute(texts, order, least):
    count, total = Counter(), 0
    for t in texts:
        w = words(t)
        total += len(w)
        count.update(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))

    def s(gram):
        if len(gram) == 1:
            return math.log(count[gram] / total), 1
        if count[gram] >= least:
            return math.log(count[gram] / count[gram[:-1]]), len(gram)
        value, used = s(gram[1:])
        return value + math.log(0.4), used

    out = []
    for t in texts:
        w = words(t)
        got = [s(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w))]
        out.append((len(w), sum(u == 1 for _, u in got), sum(v for v, _ in got) / len(w) if w else None))
    return out


@pytest.mark.parametrize(("order", "block", "entries", "least"), [(1, 500, 100, 2), (2, 400, 64, 2), (3, 3000, 200, 2), (2, 1 << 20, 1 << 20, 2), (3, 400, 64, 1)])
def test_against_plain_counts(spark, order, block, entries, least):
    rng = random.Random(order)
    texts = [None, "", " \t ", "one", *[" ".join(rng.choice("a b c dd é ü\x0bx y z w1 w2 w3 rare".split(" ")) for _ in range(rng.randrange(60))) for _ in range(60)]]
    texts += [texts[5], "long " * 3000]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(1000, "same row")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("block", F.lit(0))
    got = sorted((str(r.doc_id), r.n_words, r.n_unigram, round(r.score, 9) if r.score is not None else -99) for r in ngram_lm.score(docs, order, least, block, entries).collect())
    want = sorted((str(i), n, u, round(s, 9) if s is not None else -99) for (i, _), (n, u, s) in zip(rows, brute([t for _, t in rows], order, least), strict=True))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-6 for g, w in zip(got, want, strict=True))


def test_lists_survive_packing():
    x = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (ngram_lm.unpacked(ngram_lm.packed(x)) == x).all()
    assert len(ngram_lm.numbers(ngram_lm.planes(x[:0]))) == 0


def test_empty(spark):
    assert ngram_lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_memory_of_a_block_is_a_few_numbers_a_word():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 50000, 400))).encode() for _ in range(500)]
    block = pa.record_batch({"block": [7], "doc_ids": [[*range(500)]], "lengths": [[*map(len, texts)]], "z": [zstandard.compress(b"".join(texts))]})
    tracemalloc.start()
    lists = pa.Table.from_batches(ngram_lm._lists(3, 3)(iter([block])))
    listed = tracemalloc.get_traced_memory()[1]
    answers = pa.concat_tables([ngram_lm._totals(lists.slice(i, 1)) for i in range(lists.num_rows)])
    tracemalloc.reset_peak()
    scored = ngram_lm._scores(3, 1, 200000)(pa.Table.from_batches([block]), answers)
    peak = max(listed, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    want = brute([t.decode() for t in texts], 3, 1)
    assert scored.column("n_words").to_pylist() == [n for n, _, _ in want]
    assert np.allclose(scored.column("score").to_pylist(), [s for _, _, s in want])
    assert peak < 160 * 200000  # bytes a word; 212 with all hashes, places and answers at once


def test_tidy_tables_leave_no_shuffle_files(spark, monkeypatch):
    at_write, write = [], DataFrameWriter.parquet

    def parquet(writer, path, *a, **b):
        at_write.append((path.rsplit("/", 1)[-1][:12], spark.conf.get(TIDY)))
        return write(writer, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    ngram_lm.score(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect()
    tidied = [on for name, on in at_write if name == "ngram-totals"]
    assert tidied == ["true"]
    assert spark.conf.get(TIDY) == "false"
