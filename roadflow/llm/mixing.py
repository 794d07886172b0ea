"""Mixing sources to target weights in fixed-length blocks.

Packing: a source's documents follow each other in a pseudo-random order that depends on the rows alone, and
their words are cut into blocks of ``block`` words (the last may be shorter).

Targets: sources by code point, nulls last, have the weights ``WEIGHTS`` in turn and share ``share`` times
all words; a target stops at ``cap`` times its source's words, and the excess goes to the others by weight.
The stop level is found from running sums over the sources in order of cap / weight.

Drawing: a source gets the number of slots that brings its words nearest to its target. Each slot draws its
output shard, so that the counts of the sources in a shard are multinomial draws given the corpus totals.
A source's slots are read in epochs of as many slots as it has blocks, and within an epoch a pseudo-random
permutation of the block numbers (swap-or-not rounds, exact for any number of blocks) maps a slot to a block.
So a block is taken once per epoch at most, no document exceeds ``cap`` times its size when cap is a whole
number, and equal input gives equal output. Slots and blocks are joined by (source, block number).

A source may hold most rows: positions come from sums over 4096 hash ranges of each source, so a window never
holds more than one range or the 4096 sums of a source, and slots are made in chunks. Only the table of
sources (one row each) is ever in one task. Nothing is collected.

Defined results: a null text has size 0; a document of size 0 takes 0, in no slot and shard; repeated rows are
documents of their own; a null source is a source; an empty table gives no rows; a very long text is cut into as many
pieces as it has blocks; further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.llm.common import SPACE, row_key, stored, text_or_empty

#: Fixed values of the mix: weights in turn, share of all words, and most often a word may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK = 64
SHARD_SLOTS = 4096
ROUNDS = 32
CHUNK = 1 << 12
RANGES_BITS = 12


def words_of(text: Column) -> Column:
    """The words of a text without nulls; a text without words gives one empty string."""
    return F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), f"[{SPACE}]+", -1)


def word_count(text: Column) -> Column:
    pieces = F.split(text, f"[{SPACE}]+", -1)
    blank = lambda i: F.element_at(pieces, i) == ""
    return (F.size(pieces) - blank(1).cast("int") - ((F.size(pieces) > 1) & blank(-1)).cast("int")).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """(rank, source, source_size, target) of a table with source and size; rank counts sources from 1."""
    total = Window.partitionBy()
    ranked = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") - 1) % len(WEIGHTS) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("stop", F.lit(CAP) * F.col("source_size"))
    order = Window.orderBy(F.col("stop") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("stop").over(before), F.lit(0))
    weights_left = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.lit(SHARE) * F.sum("source_size").over(total) - spent) / weights_left
    ranked = ranked.withColumn("level", level).withColumn("full", F.col("stop") <= F.col("level") * F.col("weight"))
    # the level at the first source that stays below its stop holds for all after it
    ranked = ranked.withColumn("level", F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("full") | F.col("level").isNull(), F.col("stop").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return ranked.select("rank", "source", "source_size", target.alias("target"))


def packed(documents: DataFrame) -> DataFrame:
    """``documents`` (with columns size and rank, of the source) and ``first``, the place in its source's stream
    of words at which the document starts. Texts move once: window and join share the keys rank and range."""
    keyed = documents.withColumn("_h", F.xxhash64("_key")).withColumn("_range", F.shiftrightunsigned("_h", 64 - RANGES_BITS).cast("int"))
    ranges = keyed.groupBy("rank", "_range").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("rank").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("rank", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("rank", "_range").orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(ranges, ["rank", "_range"]).withColumn("first", F.col("_base") + F.col("_in")).drop("_h", "_range", "_base", "_in")


def permuted(x: Column, n: Column, *seeds: Column) -> Column:
    """A pseudo-random permutation of 0..n-1 chosen by the seeds, at ``x``: swap-or-not rounds."""

    def swap(y: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*seeds, r), n) - y, n)
        return F.when(F.xxhash64(*seeds, r, F.greatest(y, mirror)) % 2 == 0, y).otherwise(mirror)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap)


def slots(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 42) -> DataFrame:
    """(rank, slot, shard, block): every slot of every source, its output shard and the block it reads."""
    sized = targets.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
    sized = sized.withColumn("n", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    sized = sized.withColumn("shards", F.ceil(F.sum("n").over(Window.partitionBy()) / shard_slots))  # before the explode
    chunks = sized.where("n > 0").select("rank", "blocks", "n", "shards", F.explode(F.expr(f"sequence(0, (n - 1) div {CHUNK})")).alias("chunk"))
    # by number: a few small rows here become all the work of the next step, so AQE must not put them together
    chunks = chunks.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "chunk")
    every = chunks.select("rank", "blocks", "shards", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(n, (chunk + 1) * {CHUNK}) - 1)")).alias("slot"))
    epoch = F.expr("slot div blocks")
    return every.select(
        "rank",
        "slot",
        F.pmod(F.xxhash64(F.lit(seed), "rank", "slot"), F.col("shards")).alias("shard"),
        permuted(F.expr("slot % blocks"), F.col("blocks"), F.lit(seed), F.col("rank"), epoch).alias("block"),
    )


def shard_counts(drawn: DataFrame) -> DataFrame:
    """The draw itself: the number of slots of each source in each output shard."""
    return drawn.groupBy("shard", "rank").agg(F.count("*").alias("n_slots"))


def _pieces(placed: DataFrame, block: int, *kept: str) -> DataFrame:
    """A row for each block that a document of some size has words in: block, begins (their first place in
    the stream), length (their number), text if ``placed`` has words, and the columns ``kept``."""
    begins = lambda b: F.greatest(F.col("first"), b * block)
    length = lambda b: F.least(F.col("first") + F.col("size"), (b + 1) * block) - begins(b)
    fields = lambda b: [b.alias("block"), begins(b).alias("begins"), length(b).alias("length")]
    if "words" in placed.columns:  # all pieces of a document are cut from one split of its text
        cut = lambda b: F.slice("words", (begins(b) - F.col("first") + 1).cast("int"), F.least(length(b).cast("int"), F.size("words")))
        fields = lambda b, of=fields: [*of(b), F.array_join(cut(b), " ").alias("text")]
    blocks = F.expr(f"sequence(first div {block}, (first + size - 1) div {block})")
    return placed.where("size > 0").select(*kept, F.inline(F.transform(blocks, lambda b: F.struct(*fields(b)))))


def taken_words(documents: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words the mix takes, repeats counted), and of the draw n_slots
    (slots that hold words of the document) and the first and last output shard of them, a row per document."""
    sized = documents.select("doc_id", "source", word_count(text_or_empty()).alias("size"), row_key("doc_id", text_or_empty()).alias("_key"))
    sized = stored(sized, "mix-sizes")
    targets = stored(source_targets(sized), "mix-sources")
    times = slots(targets, block, seed=seed).groupBy("rank", "block").agg(F.count("*").alias("times"), F.min("shard").alias("low"), F.max("shard").alias("high"))
    named = targets.select("rank", F.col("source").alias("_s"), "source_size", "target")
    placed = packed(sized.join(named, F.expr("source <=> _s")).drop("_s")).drop("_key")
    same = ["doc_id", "source", "size", "source_size", "target"]
    # the planner takes the slots for as small as the sources they are made from: never broadcast them
    pieces = _pieces(placed, block, *same, "rank", "first").join(times.hint("merge"), ["rank", "block"], "left")
    times = F.coalesce("times", F.lit(0))
    counted = pieces.groupBy(*same, "rank", "first").agg(
        F.sum(F.col("length") * times).alias("taken"),
        F.sum(times).alias("n_slots"),
        F.min("low").alias("first_shard"),
        F.max("high").alias("last_shard"),
    )
    none, drawn = F.lit(0).cast("long"), ["taken", "n_slots", "first_shard", "last_shard"]
    unknown = F.lit(None).cast("long")
    empty = placed.where("size = 0").select(*same, none.alias("taken"), none.alias("n_slots"), unknown.alias("first_shard"), unknown.alias("last_shard"))
    return counted.select(*same, *drawn).unionByName(empty)


def mixed_blocks(documents: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """The mix itself, a row per slot: shard, slot, source, block, doc_ids (in order), n_words and text (the
    block's words between single spaces)."""
    text = text_or_empty()
    sized = documents.select("doc_id", "source", text.alias("text"), word_count(text).alias("size"), row_key("doc_id", text).alias("_key"))
    targets = stored(source_targets(sized.select("source", "size")), "mix-sources")
    named = targets.select("rank", F.col("source").alias("_s"))
    placed = packed(sized.join(named, F.expr("source <=> _s")).drop("_s"))
    placed = placed.withColumn("words", words_of(F.col("text"))).drop("text")
    pieces = _pieces(placed, block, "rank", "source", "doc_id").select("rank", "source", "block", F.struct("begins", "doc_id", "length", "text").alias("piece"))
    # by the keys of the join that follows, so that the blocks' texts move once for both
    blocks = pieces.groupBy("rank", "block").agg(F.first("source").alias("source"), F.sort_array(F.collect_list("piece")).alias("pieces"))  # at most ``block`` pieces
    filled = blocks.join(slots(targets, block, seed=seed).hint("merge"), ["rank", "block"])
    n_words = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return filled.select("shard", "slot", "source", "block", F.col("pieces.doc_id").alias("doc_ids"), n_words.alias("n_words"), F.array_join("pieces.text", " ").alias("text"))
