"""SimHash near-duplicates: fingerprints, links found with pivot distance tables, components.

Fingerprint: words of the text (A-Z lowered) in shingles, each hashed by XXH64 (UTF-8, seed 42); a bit of the
fingerprint is 1 if it is set in over half the hashes, repeats included. Fewer words than a shingle: one
shingle of them all; no words: fingerprint zero.

Links: fingerprints at ``max_bits`` (up to 2) or fewer differing bits. For every distinct fingerprint the
Hamming distances to ``PIVOTS`` are computed: the zero fingerprint and 32 reference fingerprints with two
adjacent bits each. The distances to a reference and to zero differ by the number of bits the fingerprint
has in that pair, so ``max_bits`` changed bits change at most ``max_bits`` of these 32 coordinates. With the
coordinates in six groups, two near fingerprints agree in at least four whole groups: each of the 15 choices
of four is a table, and only fingerprints that agree there meet. Pairs whose largest coordinate difference
exceeds ``max_bits`` are discarded (the triangle inequality) and survivors are verified by their bits.

A table's bin can hold many fingerprints (groups of near copies). Bins of up to ``BIN`` fingerprints compare
all their pairs. The fingerprints of larger bins take an exact way without pairs: each is listed under itself
and its 64 neighbours at one bit; two fingerprints are within two bits if and only if they share such an
entry, so linking each member of an entry to the entry's smallest member joins the same components with 65
rows a fingerprint. Entries are aggregated before the shuffle, and no bin or entry is ever collected.

Components are found by alternating large-star and small-star rounds over the links between distinct
fingerprints, each written to the shared folder.

Defined results: a null text has no words; a null doc_id is named by the others of its component (null if
there are none); repeated rows are one fingerprint; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import fresh, row_key, stored, text_or_empty

SHINGLE = 3
MAX_BITS = 2
BIN = 32
GROUPS = 6
#: Reference fingerprints: zero, and two adjacent bits each.
PIVOTS = (0, *(3 << (2 * i) for i in range(32)))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in map(b" ".join, runs)], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = hashes[i : i + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (names the row by id and text) and fp, the fingerprint as a signed long, a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", text_or_empty()).alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key string, fp long")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _bins(fps: DataFrame) -> DataFrame:
    """fp, its pivot distances, and the bin it has in each of the 15 tables.

    Lambdas over short literal lists: written out, the 33 distances and 60 keys make code whose compilation
    takes more memory than the data.
    """
    pivots = F.array(*[F.lit(p - (1 << 64) if p >> 63 else p).cast("long") for p in PIVOTS])
    groups = F.array(*[F.array(*map(F.lit, range(g, 32, GROUPS))) for g in range(GROUPS)])
    tables = F.array(*[F.struct(F.lit(t).cast("byte").alias("t"), *[F.lit(g).alias(f"g{j}") for j, g in enumerate(c)]) for t, c in enumerate(combinations(range(GROUPS), GROUPS - 2))])
    # bits of a pair = (distance to zero - distance to the reference + 2) / 2, in base 3 for a short key
    coordinate = lambda i: ((F.col("d")[0] - F.col("d")[i + 1] + 2) / 2).cast("int")
    key = lambda members: F.aggregate(members, F.lit(0), lambda k, i: k * 3 + coordinate(i))
    named = lambda c: F.struct(c["t"].alias("t"), *[F.col("g")[c[f"g{j}"]].alias(f"k{j}") for j in range(GROUPS - 2)])
    table = fps.select("fp", F.transform(pivots, lambda p: _distance(F.col("fp"), p).cast("byte")).alias("d"))
    return table.withColumn("g", F.transform(groups, key)).select("fp", "d", F.explode(F.transform(tables, named)).alias("bin"))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints that join the components of all links."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    bins = _bins(fps)
    sizes = bins.groupBy("bin").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(bins.join(sizes, "bin"), "simhash-bins")

    few = shared.where(F.col("n") <= BIN)
    x, y = (few.select(F.col("bin").alias(f"{s}bin"), F.col("fp").alias(s), F.col("d").alias(f"{s}d")) for s in "ab")
    farthest = F.array_max(F.zip_with("ad", "bd", lambda p, q: F.abs(p - q)))
    pairs = x.join(y, F.expr("abin = bbin and a < b")).where(farthest <= max_bits).where(_distance(F.col("a"), F.col("b")) <= max_bits)

    many = shared.where(F.col("n") > BIN).select("fp").distinct()
    if max_bits == 2:
        near = F.concat(F.array(F.col("fp")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
        entries = many.select("fp", F.explode(near).alias("entry"))
    else:  # one bit apart: the fingerprint itself and, under a mark of the bit, what is left without it
        masked = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.struct(i.alias("i"), F.col("fp").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i).bitwiseXOR(F.lit(-1))).alias("v")))
        entries = many.select("fp", F.explode(masked).alias("entry")).where(F.lit(max_bits == 1))
    least = entries.groupBy("entry").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").drop("z")
    stars = entries.join(least, "entry").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.select("a", "b").unionByName(stars).distinct()


def components(edges: DataFrame, name: str = "simhash") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star (MapReduce connected components): each round links a node's larger
    neighbours, then its smaller ones, to the smallest of them, until all links end in a root.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star over large: every smaller neighbour and the node itself point to the smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after = stored(small, f"{name}-links")
        # settled: no node is linked twice and no root is itself linked
        loose = after.groupBy("u").count().where("count > 1").limit(1).count() or after.join(after.select(F.col("u").alias("r")), F.col("v") == F.col("r"), "left_semi").limit(1).count()
        edges = after
        if not loose:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, key, fp, component_id (the component's smallest doc_id) and kept_key, a row per document.

    ``kept_key`` is the key of the component's first document by doc_id, nulls last, then key.
    """
    fps = stored(fingerprints(documents, shingle), "simhash-fps")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    distinct = fps.groupBy("fp").agg(F.min(first).alias("first"))
    roots = components(links(stored(distinct.select("fp"), "simhash-distinct"), max_bits))
    rooted = stored(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("least"))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("kept_key"))
    return fps.join(classes, "fp").select("doc_id", "key", "fp", "component_id", "kept_key")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: its first by doc_id (nulls last); of repeated rows, one."""
    kept = near_duplicates(documents, shingle, max_bits).where("key = kept_key").select("kept_key").distinct()
    key = fresh(documents, "key")
    keyed = documents.withColumn(key, row_key("doc_id", text_or_empty()))
    return keyed.join(kept, F.col(key) == F.col("kept_key"), "left_semi").dropDuplicates([key]).drop(key)
