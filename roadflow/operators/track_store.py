"""Requests against a stored log without reading all of it: a plate-clustered table (J7 P3) and a Bloom prefilter for
lists too large to broadcast (J6 J7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.operators.track import requested_sightings

#: Requests up to this many are sent to the scan as values; more are joined.
MOST_VALUES = 1000


def write_plate_store(flow: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store sightings in ``buckets`` files by plate, sorted by plate and time within each. Rebalancing lets AQE
    split the bucket of a vehicle with very many sightings over several writers (and files).

    ``buckets`` fixes how much a request reads (about 1 / buckets of the log) and how many tasks a join with the
    store has: size it so that a bucket is a few hundred MB."""
    spread = flow.hint("rebalance", buckets, "plate")
    spread.write.mode("overwrite").bucketBy(buckets, "plate").sortBy("plate", "action_time").option("path", path).saveAsTable(table)


def open_plate_store(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The store at ``path`` as a table of this session, with its buckets known to the planner."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"create table {table} ({columns}) using parquet clustered by (plate) sorted by (plate, action_time) "
            f"into {buckets} buckets location '{path}'"
        )
    return spark.table(table)


def stored_sightings(store: DataFrame, requests: DataFrame, most: int = MOST_VALUES) -> DataFrame:
    """Sightings of the requested plates. Up to ``most`` plates go to the scan as values, which reads their
    buckets only; more are joined, where the requests are dealt to the store's buckets and the sightings stay."""
    plates = requests.where(F.length("plate") > 0).select("plate").distinct()
    values = [r.plate for r in plates.limit(most + 1).collect()]  # bounded by the parameter
    if len(values) <= most:
        return store.where(F.col("plate").isin(values))
    return requested_sightings(store, plates)


# --- Bloom prefilter -----------------------------------------------------------------------------------------------

WORD = 64
HASHES = 4


def filter_bits(expected: int, per_plate: int = 10, most: int = 1 << 26) -> int:
    """Bits of a filter for ``expected`` plates: a power of two, at most 8 MB. A longer list than that makes the
    filter let more through; the join after it stays exact."""
    return min(most, max(1 << 12, 1 << (expected * per_plate - 1).bit_length()))


def _places(plate: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), plate), F.lit(bits)) for i in range(HASHES)]


def plate_filter(plates: DataFrame, bits: int) -> DataFrame:
    """One row, ``words``: the filter as ``bits / 64`` longs. The list is reduced to set words in its own tasks; the
    row's size is that of the filter, not of the list."""
    word = F.expr(f"cast(shiftright(place, {WORD.bit_length() - 1}) as bigint)")
    bit = F.expr(f"shiftleft(1L, cast(place & {WORD - 1} as int))")
    places = plates.select(F.explode(F.array(*_places(F.col("plate"), bits))).alias("place"))
    words = places.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    whole = plates.sparkSession.range(bits // WORD).join(words, F.col("id") == F.col("word"), "left")
    ordered = whole.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("w"))
    return ordered.select(F.transform("w", lambda x: x["bits"]).alias("words"))


def may_hold(words: Column, plate: Column, bits: int) -> Column:
    """Whether the filter may hold a plate: never false for one of the list."""
    found = F.lit(True)
    for place in _places(plate, bits):
        word = F.get(words, (place / WORD).cast("int"))
        found = found & (F.getbit(word, (place % WORD).cast("int")) == 1)
    return found


def prefiltered(flow: DataFrame, plates: DataFrame, expected: int) -> DataFrame:
    """Sightings that pass the filter of a list: all of the listed plates', and few others. The filter is built
    once, before the scan, and goes to its tasks with the plan."""
    bits = filter_bits(expected)
    words = plate_filter(plates.where(F.length("plate") > 0).select("plate").distinct(), bits).scalar()
    return flow.where(may_hold(words, F.col("plate"), bits))


def listed_sightings(flow: DataFrame, plates: DataFrame, expected: int) -> DataFrame:
    """Sightings of a list of plates that is too large to broadcast: filtered before the shuffle, then joined
    exactly. ``expected`` (the list's rough length) sizes the filter."""
    listed = plates.where(F.length("plate") > 0).select("plate").distinct().hint("merge")
    return prefiltered(flow, plates, expected).join(listed, "plate", "left_semi")
