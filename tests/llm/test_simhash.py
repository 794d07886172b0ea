"""SimHash: fingerprints, links and components against brute force."""

import random
from itertools import combinations

import pandas as pd
import xxhash
from pyspark.sql import functions as F

from roadflow.llm import simhash


def brute_fp(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint_matches_definition():
    for text in ["", None, " \t\n", "one", "Two  words", "a b c", "a b c a b c a b c", "É é É x   y Z", "w " * 500]:
        assert simhash.fingerprint(text) == brute_fp(text)


def test_links_and_components_of_chains_and_dense_bins(spark):
    rng = random.Random(5)
    chain = [rng.getrandbits(64)]
    for _ in range(40):
        chain.append(chain[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    centre = rng.getrandbits(64)
    dense = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}  # more than a bin
    fps = {x - (1 << 64) if x >> 63 else x for x in {0, 1, *chain, *dense, *(rng.getrandbits(64) for _ in range(200))}}
    table = spark.createDataFrame(pd.DataFrame({"fp": sorted(fps)}))
    for bits in (2, 1):
        want = brute_components(fps, bits)
        got = {r.node: r.root for r in simhash.components(simhash.links(table, bits)).collect()}
        assert {f: got.get(f, f) for f in fps} == want


def test_documents_with_nulls_copies_and_extra_columns(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (None, "A B c d"), (7, None), (8, ""), (9, "x y z w v"), (9, "x y z w v"), (None, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("key", F.lit(1))
    got = simhash.near_duplicates(docs).collect()
    fps = {r.fp for r in got}
    root = brute_components(fps, 2)
    ids = {}
    for r in got:
        ids.setdefault(root[r.fp], []).append(r.doc_id)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == min((i for i in ids[root[r.fp]] if i is not None), default=None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [1, 7, 9, None]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bins_are_those_of_the_pivot_distances_in_little_code(spark, capsys):
    rng = random.Random(8)
    fps = [0, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(50))]
    bins = simhash._bins(spark.createDataFrame(pd.DataFrame({"fp": [x - (1 << 64) if x >> 63 else x for x in fps]})))
    got = {(r.fp % (1 << 64), tuple(r.d), tuple(r.bin)) for r in bins.collect()}
    want = set()
    for x in fps:
        d = tuple((x ^ p).bit_count() for p in simhash.PIVOTS)
        keys = [0] * simhash.GROUPS
        for i in range(32):
            keys[i % simhash.GROUPS] += (x >> (2 * i) & 3).bit_count() * 3 ** (5 - i // simhash.GROUPS if i % simhash.GROUPS < 2 else 4 - i // simhash.GROUPS)
        want |= {(x, d, (t, *(keys[g] for g in c))) for t, c in enumerate(combinations(range(simhash.GROUPS), 4))}
    assert got == want
    bins.explain("codegen")
    assert len(capsys.readouterr().out) < 40_000  # 197 thousand characters with the distances written out
