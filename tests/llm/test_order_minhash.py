"""Order MinHash: neighbours and edited texts against brute force, equal texts, order, likeness."""

import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from roadflow.llm import order_minhash


def test_edited_texts_and_likeness(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé\U0001f600") for _ in range(5))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 300))) for _ in range(60)] + ["", None, " \t", "one", "a b", "a b c", "la " * 400]
    ids = rng.sample(range(1000), len(texts) - 1) + [None]
    rows = list(zip(ids, texts, strict=True))
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("signature", F.lit("clash"))
    got = {r.doc_id: r for r in order_minhash.edited_likeness(docs).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    total = order_minhash.edited_likeness(docs).count()
    assert total == len(rows) + 2
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + nxt[:third]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    long = [got[i] for i, t in rows if len((t or "").split()) > 60 and len(set((t or "").split())) > 20]
    mean = lambda x: sum(x) / len(x)
    assert mean([r.near_edited for r in long]) > 0.15 > 0.02 > mean([r.near_next for r in long])


def signatures(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return {r.i: r.s for r in order_minhash.with_signature(df, "text", "s").collect()}


def likeness(a, b):
    used = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in used) / len(used)


def test_signature_sees_order_repeats_and_spacing(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    moved = words[1500:] + words[:1500]  # the same k-mers but at the seam, in another order
    few = words[:1400] + ["edit"] + words[1401:]
    got = signatures(spark, [" ".join(words), "\n ".join(words), " ".join(moved), " ".join(few), "a b c " * 10, "a b c " * 11, "", "x"])
    assert got[0] == got[1] and len(got[0]) == order_minhash.PARTS
    assert likeness(got[0], got[3]) > 0.9
    assert likeness(got[0], got[2]) < 0.75  # a sketch of sets would give about 1
    assert got[4] != got[5]  # occurrences count
    assert all(any(s) for s in got.values())


def test_short_texts_see_order(spark):
    rng = random.Random(3)
    for n in (10, 20, 50, 100):
        texts = []
        for _ in range(40):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            texts += [" ".join(words), " ".join(words[n // 2 :] + words[: n // 2])]
        got = signatures(spark, texts)
        common = (n - 4) / n  # share of k-mers in both, what a sketch of sets would give
        mean = sum(likeness(got[i], got[i + 1]) for i in range(0, len(texts), 2)) / 40
        assert 0.2 * common < mean < 0.65 * common, (n, mean)
        assert all(0 not in s for s in got.values())


def test_packed_form_against_plain_python(spark):
    """Selected k-mers of a part are the least hashes; checked through a text whose k-mers are all in place."""
    got = signatures(spark, ["a b c d", "a b c d", "b c d a"])
    assert got[0] == got[1] != got[2]


def test_neighbours_cover_a_cycle_over_many_ranges(spark):
    docs = spark.range(0, 5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    docs = docs.unionByName(docs.where("doc_id < 50").select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("u"), "doc_id").alias("text")))
    got = order_minhash.neighbours(docs).collect()
    after = {r.key: r.next_key for r in got}
    assert len(after) == len(got) == 5050 and set(after) == set(after.values())
    at, seen = got[0].key, set()
    while at not in seen:
        seen.add(at)
        at = after[at]
    assert len(seen) == 5050
    assert {r.next_key: r.key for r in got} == {r.key: r.prev_key for r in got}


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.edited_likeness(none).count() == 0
    one = order_minhash.edited_likeness(spark.createDataFrame([(1, "abc def")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abc deab"[:5] + b"ab").hexdigest() and one.near_next == 1.0


def hashed(*values):
    """Spark's xxhash64: text in UTF-8, ("int", n), or a long, each seeded with the hash before."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[1]) if isinstance(v, tuple) else struct.pack("<Q", v)
        h = xxhash.xxh64_intdigest(raw, h)
    return h


def brute_signature(text):
    """The tuples of all parts: from each point of the ring the two first occurrence-numbered k-mers, in text order."""
    words = re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\f\r"))
    kmers = [hashed(*words[i : i + 3]) >> 26 for i in range(max(len(words) - 2, 1))]
    seen, ring = {}, []
    for place, h in enumerate(kmers):
        ring.append((hashed(h, ("int", seen.get(h, 0))) >> 26, place))
        seen[h] = seen.get(h, 0) + 1
    ring.sort()
    out = []
    for part in range(64):
        from_point = [r for r in ring if r[0] >= part << 32] + [r for r in ring if r[0] < part << 32]
        picked = sorted(from_point[:2], key=lambda r: r[1])
        value = hashed(*(r[0] for r in picked))
        value = (value - (1 << 64) if value >= 1 << 63 else value) % (2**32 - 1) - (2**31 - 1)
        out.append(value or 1)
    return out


def test_signature_and_likeness_against_plain_python(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["a", "b", "é", "\U0001f600", f"w{rng.randrange(50)}"]) for _ in range(rng.choice([1, 2, 3, 4, 5, 20, 90, 700]))) for _ in range(60)]
    texts += ["", " \t", "one", "a  b\n", "la " * 400, *texts[:2]]
    got = signatures(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == brute_signature(t), t

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    order = list(enumerate(texts))[::-1]
    found = {r.doc_id: r for r in order_minhash.edited_likeness(docs).collect()}
    share = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / 64
    hexed = lambda s: "".join(f"{v & 0xFFFFFFFF:08x}" for v in s)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        third = len(t) // 3
        own, edited, other = map(brute_signature, (t, t[: len(t) - third] + nxt[:third], nxt))
        assert (found[i].fingerprint, found[i].edited_fingerprint) == (hexed(own), hexed(edited))
        assert found[i].near_edited == share(own, edited) and found[i].near_next == share(own, other)
