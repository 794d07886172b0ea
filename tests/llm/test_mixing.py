"""Mixing: targets against a plain water filling, exact permutations, packing and repeats."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from roadflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2)):
    """sizes: by source. Reshare what is above the stop by weight until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        above = {s for s in free if level * w[s] >= 2 * sizes[s]}
        if not above:
            return target | {s: level * w[s] for s in free}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def docs_of(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["big", "big", "big", "é", "zz", "A", None, "tiny" if i % 90 == 0 else "b"])
        text = rng.choice([None, "", "  "]) if i % 25 == 0 else rng.choice([" ", "\t ", ""]) + rng.choice([" ", "\n"]).join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 200)))
        rows.append((rng.choice([i, i, None]), text, source))
    rows += [(5, "a b c d e", "big")] * 3 + [(6, "x y", "none \U0001f600"), (7, "long " * 5000, "A"), (8, None, "empty")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("rank", F.lit(0))


def test_mix(spark):
    rows, docs = docs_of(spark)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    got = mixing.taken_words(docs).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, size(t), s) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))

    blocks = mixing.mixed_blocks(docs).collect()
    by_source, times = Counter(), Counter()
    for b in blocks:
        assert len(b.text.split(" ")) == b.n_words <= mixing.BLOCK
        by_source[b.source] += b.n_words
        times[b.source, b.block] += 1
    assert by_source == Counter({s: n for s, n in taken.items() if n}) and max(times.values()) <= 2
    whole = {}
    for b in blocks:
        whole[b.source, b.block] = b.text
    for s in {s for s, _ in whole}:  # sources at their stop take every word twice
        if want[s] == 2 * sizes[s]:
            words = Counter(w for (o, _), t in whole.items() if o == s for w in t.split(" "))
            assert words == Counter(w for _, t, o in rows if o == s for w in WORD.findall(t or ""))


def test_permutation_is_exact(spark):
    for n in (1, 2, 3, 64, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(1), F.lit(2)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    assert [r.p for r in got] != sorted(r.p for r in got)


def test_shard_counts_follow_the_draw(spark):
    sources = spark.createDataFrame([(1, "a", 64_000_0, 64_000_0.0), (2, "b", 64_000, 128_000.0), (3, "c", 0, 0.0)], "rank int, source string, source_size long, target double")
    drawn = mixing.slots(sources, shard_slots=1000)
    counts = mixing.shard_counts(drawn).collect()
    assert sum(r.n_slots for r in counts if r["rank"] == 1) == 10_000 and sum(r.n_slots for r in counts if r["rank"] == 2) == 2_000
    for r in counts:
        p, n = 1 / 12, 10_000 if r["rank"] == 1 else 2_000
        assert abs(r.n_slots - n * p) < 6 * (n * p) ** 0.5


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken_words(none).count() == 0 and mixing.mixed_blocks(none).count() == 0


def hashed(*values):
    """Spark's xxhash64: text in UTF-8, ("int", n), or a long, each seeded with the hash before."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[1]) if isinstance(v, tuple) else struct.pack("<q", v)
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >= 1 << 63 else h


def brute_slots(targets, block=mixing.BLOCK, shard_slots=mixing.SHARD_SLOTS):
    """(rank, shard, block) of every slot, from {rank: (source_size, target)}."""
    blocks = {r: -(-size // block) for r, (size, _) in targets.items() if size}
    n = {r: math.floor(targets[r][1] * blocks[r] / targets[r][0] + 0.5) for r in blocks}
    shards = -(-sum(n.values()) // shard_slots)
    for r in blocks:
        for slot in range(n[r]):
            epoch, y = divmod(slot, blocks[r])
            seeds = (("int", 42), ("int", r), epoch)
            for k in range(1, mixing.ROUNDS + 1):
                mirror = (hashed(*seeds, ("int", k)) % blocks[r] - y) % blocks[r]
                y = y if hashed(*seeds, ("int", k), max(y, mirror)) % 2 == 0 else mirror
            yield r, hashed(("int", 42), ("int", r), slot) % shards, y


def test_taken_words_and_draw_against_plain_python(spark, monkeypatch):
    rows, docs = docs_of(spark, seed=4, n=150)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 40)
    monkeypatch.setattr(mixing.slots, "__defaults__", (mixing.BLOCK, 40, 42))
    words = lambda t: len(WORD.findall(t or ""))
    streams = defaultdict(list)
    for i, t, s in rows:
        key = hashlib.md5(f"{'null' if i is None else i}:{t or ''}".encode()).hexdigest()
        streams[s].append((hashed(key) % (1 << 64), key, i, words(t)))
    wanted = brute_targets({s: sum(d[3] for d in ds) for s, ds in streams.items()})
    names = sorted((s for s in streams if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    rank = {s: k for k, s in enumerate(names, 1)}
    drawn = defaultdict(list)
    for r, shard, b in brute_slots({rank[s]: (sum(d[3] for d in ds), wanted[s]) for s, ds in streams.items()}, shard_slots=40):
        drawn[r, b].append(shard)
    want = Counter()
    for s, ds in streams.items():
        at = 0
        for _, _, i, n in sorted(ds, key=lambda d: d[:2]):
            taken, shards = 0, []
            for b in range(at // 64, (at + n - 1) // 64 + 1) if n else ():
                inside = min(at + n, (b + 1) * 64) - max(at, b * 64)
                taken += inside * len(drawn[rank[s], b])
                shards += drawn[rank[s], b]
            want[i, s, n, taken, len(shards), min(shards, default=None), max(shards, default=None)] += 1
            at += n
    got = mixing.taken_words(docs).collect()
    assert Counter((r.doc_id, r.source, r.size, r.taken, r.n_slots, r.first_shard, r.last_shard) for r in got) == want
    assert len({x for v in drawn.values() for x in v}) > 5
