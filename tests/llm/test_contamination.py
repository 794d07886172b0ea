"""Benchmark windows against a brute-force search, offsets, blocks and edge cases."""

import random
import re
import subprocess
import sys

from pyspark.sql import functions as F

from roadflow.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, k=10):
    words = WORD.findall(low(text))
    hit, ids = set(), set()
    for i, item in items:
        other = WORD.findall(low(item))
        n = min(k, len(other))
        grams = {tuple(other[j : j + n]) for j in range(len(other) - n + 1)} if n else set()
        for j in range(len(words) - n + 1) if n else ():
            if tuple(words[j : j + n]) in grams:
                hit |= set(range(j, j + n))
                ids.add(str(i) if i is not None else "null")
    return len(words), len(hit), sorted(ids)


def test_against_brute_force_in_one_and_many_blocks(spark):
    rng = random.Random(3)
    vocab = ["a", "B", "é", "x1", "Zz", "日本", "q"]
    some = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, some(rng.choice([1, 4, 10, 12, 15]))) for i in range(12)] + [(3, "a b"), (None, "null item words"), (20, None), (21, "!!"), (22, "")]
    texts = [None, "", "..", "Null  ITEM words", *[some(rng.randrange(60)) for _ in range(40)]]
    texts += [f"{some(5)}; {t}! {some(3)}" for _, t in items if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_hit", F.lit("clash")).withColumn("extra", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [brute(t, items) for t in texts]
    for size in (1 << 20, 40):
        got = {r.doc_id: r for r in contamination.find_contamination(docs, bench, block_bytes=size).collect()}
        for i, (text, w) in enumerate(zip(texts, want, strict=True)):
            r = got[i]
            assert (r.n_words, r.n_hit, r.item_ids) == w
            for word, span in zip(r.hit_words, r.spans, strict=True):
                inside = text[span["first"] : span["last"]]
                assert WORD.findall(low(inside)) == WORD.findall(low(text))[word["first"] : word["last"]]
    kept = contamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in enumerate(want) if not w[1]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination.find_contamination(none, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert contamination.find_contamination(one, bench.where("false")).first().n_hit == 0


MEASURE = """
import random, sys
from roadflow.llm import contamination as c

def resident():
    return int(open("/proc/self/statm").read().split()[1]) * 4096

rng = random.Random(1)
n_items, n_words, vocab = map(int, sys.argv[1:])
items = [(str(i), " ".join(f"w{rng.randrange(vocab):06d}" for _ in range(n_words))) for i in range(n_items)]
import ahocorasick
before = resident()
kept = c.PatternAutomaton(items, c.WINDOW)
print(resident() - before, c.automaton_bytes(sum(c.automaton_size(len(c.folded_words(t)), c.WINDOW) for _, t in items)))
"""


def test_automaton_stays_in_its_bound():
    for n_items, n_words, vocab in ((5000, 60, 20_000), (500, 600, 999_999), (50_000, 6, 999_999)):
        out = subprocess.run([sys.executable, "-c", MEASURE, str(n_items), str(n_words), str(vocab)], capture_output=True, text=True, check=True)
        taken, bound = map(int, out.stdout.split())
        assert taken <= bound, (n_items, n_words, vocab, taken, bound)
        assert bound < 4 * taken, (n_items, n_words, vocab, taken, bound)


def test_blocks_keep_to_the_bound(spark):
    items = [(i, "w " * (i % 40)) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    size = lambda t: contamination.automaton_size(len(WORD.findall(t)), 10)
    blocks = list(contamination.item_blocks(bench, 200_000))
    assert len(blocks) > 3 and sorted(int(i) for b in blocks for i, _ in b) == list(range(300))
    assert all(contamination.automaton_bytes(sum(size(t) for _, t in b)) <= 200_000 for b in blocks)


def test_very_long_text_and_repeated_items(spark):
    item = " ".join(f"x{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "a b " * 200_000 + item + " c" * 100_000), (2, "Q r")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, item + " more"), (9, "q R")], "item_id long, text string")
    got = {r.doc_id: r for r in contamination.find_contamination(docs, bench).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].item_ids) == (500_012, 12, ["7", "8"])
    assert (got[2].n_hit, got[2].item_ids) == (2, ["9"])
