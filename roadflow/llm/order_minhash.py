"""Order MinHash fingerprints, with DataFrame functions only.

A text's words give k-mers of ``K`` words (one shorter k-mer for a shorter text). A k-mer that occurs again
is numbered, so the text is a set of (k-mer, occurrence). Their hashes are put on a ring that ``PARTS`` points
cut into equal parts; the way round the ring from a point is one permutation of all k-mers. For each point the
``PICK`` first k-mers from there on (in the part behind it or, if that holds fewer, in those that follow) are
selected, put in the order of their places in the text, and hashed as a tuple. The tuples of all points are the
signature. Two texts agree in a tuple when they have the same minimal k-mers in the same order, so that moved
text lowers the likeness where a set sketch would not see it. Likeness is the share of agreeing tuples.

Each text is handled inside its row by array functions: hashes and places are packed into longs (38 bits of
hash, 26 of place: up to 67 million words a text), sorted as primitive arrays, and read in runs. No k-mer is
ever shuffled and no Python runs.

Defined results: a null text is empty and has one (empty) k-mer; equal texts have equal signatures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.llm.common import row_key, stored, text_or_empty
from roadflow.llm.mixing import words_of

K = 3
PARTS = 64
PICK = 2
PLACE_BITS = 26
PLACE = (1 << PLACE_BITS) - 1
PART_BITS = PARTS.bit_length() - 1


def _hash_bits(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def _part(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - PART_BITS)


def _pack(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~PLACE)).bitwiseOR(place.cast("long"))


def _run_starts(column: str, of) -> Column:
    """The indices at which ``of`` (a function of an element) differs from the element before."""
    at = lambda i: F.get(F.col(column), i)
    return F.filter(F.sequence(F.lit(0), F.size(column) - 1), lambda i: (i == 0) | (of(at(i)) != of(at(i - 1))))


def with_signature(df: DataFrame, text: str, signature: str) -> DataFrame:
    """``df`` with the signature of a text column that has no nulls: ``PARTS`` ints other than 0.

    The columns _w, _s, _r, _n and _b are used on the way.
    """
    kept = df.columns
    word = lambda i: F.get(F.col("_w"), i)
    kmer = lambda i: F.xxhash64(*[word(i + k) for k in range(K)])
    places = F.sequence(F.lit(0), F.greatest(F.size("_w") - K, F.lit(0)))
    # k-mers sorted by hash, then place: equal ones are runs, and an element's place in its run numbers it
    out = df.withColumn("_w", words_of(F.col(text)))
    out = out.withColumn("_s", F.sort_array(F.transform(places, lambda i: _pack(kmer(i), i)))).drop("_w")
    out = out.withColumn("_r", _run_starts("_s", _hash_bits))
    at = lambda c, i: F.get(F.col(c), i)
    numbered = lambda start, i: _pack(F.xxhash64(_hash_bits(at("_s", i)), i - start), at("_s", i).bitwiseAND(F.lit(PLACE)))
    last = lambda j: F.coalesce(at("_r", j + 1), F.size("_s")) - 1
    runs = F.transform("_r", lambda start, j: F.transform(F.sequence(start, last(j)), lambda i: numbered(start, i)))
    out = out.withColumn("_n", F.sort_array(F.flatten(runs))).drop("_s", "_r")
    out = out.withColumn("_b", _run_starts("_n", _part))

    def tuple_hash(i: Column) -> Column:
        a, b = at("_n", i), at("_n", (i + 1) % F.size("_n"))
        ordered = a.bitwiseAND(F.lit(PLACE)) < b.bitwiseAND(F.lit(PLACE))
        both = F.when(ordered, F.xxhash64(_hash_bits(a), _hash_bits(b))).otherwise(F.xxhash64(_hash_bits(b), _hash_bits(a)))
        value = F.when(F.size("_n") > 1, both).otherwise(F.xxhash64(_hash_bits(a)))
        number = F.pmod(value, F.lit(2**32 - 1)) - (2**31 - 1)
        return F.when(number == 0, 1).otherwise(number)  # an int other than 0

    tuples = F.map_from_entries(F.transform("_b", lambda i: F.struct(_part(at("_n", i)).cast("int").alias("k"), tuple_hash(i).cast("int").alias("v"))))
    out = out.withColumn("_t", tuples)
    # the second use of _t keeps the optimizer from moving its expression into the function, to run for each part
    every = F.sequence(F.lit(0), F.when(F.size("_t") >= 0, PARTS - 1).otherwise(0))
    keys = F.map_keys("_t")
    following = lambda p: F.coalesce(F.array_min(F.filter(keys, lambda k: k > p)), F.array_min(keys))
    tuple_at = lambda k: F.element_at(F.col("_t"), k)
    parts = F.transform(every, lambda p: F.coalesce(tuple_at(p), tuple_at(following(p))))
    return out.select(*kept, parts.alias(signature))


def likeness(a: str, b: str) -> Column:
    """Share of agreeing parts (0 to 1) of two signature columns."""
    used = F.zip_with(a, b, lambda x, y: ((x != 0) | (y != 0)).cast("int"))
    same = F.zip_with(a, b, lambda x, y: ((x == y) & (x != 0)).cast("int"))
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, v: s + v)
    return total(same).cast("double") / total(used)


def as_text(signature: str) -> Column:
    """The signature as a string: eight hex digits a part."""
    return F.lower(F.array_join(F.transform(signature, lambda v: F.lpad(F.hex(v.cast("long").bitwiseAND(F.lit(2**32 - 1))), 8, "0")), ""))


def neighbours(documents: DataFrame) -> DataFrame:
    """(key, next_key, prev_key, prev_chars) of every distinct document in descending order of doc_id, nulls
    last, then key; after the last comes the first.

    The order is global without one task that sees all rows: keys are dealt in ranges, and each range's ends
    are joined to those of the ranges beside it (one row per range).
    """
    rows = documents.select(row_key("doc_id", text_or_empty()).alias("key"), "doc_id", F.length(text_or_empty()).alias("chars")).distinct()
    dealt = rows.repartitionByRange(F.desc_nulls_last("doc_id"), F.asc("key")).withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, "omh-ranges")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.col("doc_id")).alias("down"), "key", "chars")
    ends = dealt.groupBy("range").agg(F.min(order).alias("head"), F.max(order).alias("tail"))
    line, whole = Window.orderBy("range"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "range",
        F.coalesce(F.lead("head").over(line), F.first("head").over(whole)).alias("after"),
        F.coalesce(F.lag("tail").over(line), F.last("tail").over(whole)).alias("before"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc_nulls_last("doc_id"), "key")
    placed = dealt.withColumns({"n_key": F.lead("key").over(inside), "p_key": F.lag("key").over(inside), "p_chars": F.lag("chars").over(inside)}).join(ends, "range")
    return placed.select(
        "key",
        F.coalesce("n_key", "after.key").alias("next_key"),
        F.coalesce("p_key", "before.key").alias("prev_key"),
        F.coalesce("p_chars", "before.chars").alias("prev_chars"),
    )


def edited_likeness(documents: DataFrame) -> DataFrame:
    """Every document with its fingerprint, that of its edited text, and its likeness to that and to the next
    document.

    The edited text has its last third (of code points, rounded down) replaced by the first as many of the
    next document by descending doc_id. Repeated rows (same id and text) are one document in that order and
    get equal results. Texts are shuffled once, by row; only the piece each hands to its predecessor moves
    again.
    """
    text = text_or_empty()
    keyed = documents.select("doc_id", text.alias("text"), row_key("doc_id", text).alias("key"))
    keyed = with_signature(keyed, "text", "signature").withColumn("n_chars", F.length("text").cast("long"))
    order = neighbours(documents)
    rows = keyed.join(order.select(F.col("key").alias("of"), "prev_key", "prev_chars"), F.col("key") == F.col("of")).drop("of")
    one = Window.partitionBy("key").orderBy("doc_id", "n_chars")
    handed = rows.withColumn("copy", F.row_number().over(one)).where("copy = 1")
    handed = handed.select(F.col("prev_key").alias("to"), F.expr("left(text, prev_chars div 3)").alias("piece"), F.col("signature").alias("next_signature"))
    both = rows.join(handed, F.col("key") == F.col("to"))
    third = F.expr("cast(n_chars div 3 as int)")
    edited = both.select("doc_id", "n_chars", "signature", "next_signature", F.concat(F.expr("left(text, cast(n_chars - n_chars div 3 as int))"), F.substring("piece", F.lit(1), third)).alias("edited"))
    edited = with_signature(edited, "edited", "edited_signature")
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("signature").alias("fingerprint"),
        as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
    )
