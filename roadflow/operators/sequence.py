"""Per-key ordered operations (previous row, step number, ordered lists) that stay balanced when one key is hot.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so one plate holding a third of
all sightings would be sorted by one task. Here the rows of a key are cut into time buckets (a day):

- the window runs per (key, bucket);
- what crosses a bucket's edge (the last row before it, the rows counted before it) comes from a window over
  one row per (key, bucket), joined back on (key, bucket).

It is one lazy plan for every size: no row counts, no sampling, no checkpoint, and no second algorithm for
small inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def _beside(df: DataFrame, per_bucket: DataFrame, key: str) -> DataFrame:
    """``df`` left-joined to a frame with one row per (_k, _b); null keys and buckets match."""
    return df.join(per_bucket, F.col(key).eqNullSafe(F.col("_k")) & F.col(BUCKET).eqNullSafe(F.col("_b")), "left")


def lag_by_key(df: DataFrame, key: str, order: list[str], cols: list[str], bucket: Column) -> DataFrame:
    """``df`` plus ``prev_<c>`` for each of ``cols``: the value on the previous row of the same key in
    (order...) order, null on a key's first row. Same result as
    ``lag(c) over (partition by key order by order...)``.

    ``bucket`` must not decrease along (order...) within a key, e.g. the day of ``order[0]``."""
    w = Window.partitionBy(key, BUCKET).orderBy(*order)
    within = df.withColumn(BUCKET, bucket).select(
        "*",
        F.row_number().over(w).alias("_rn"),
        F.lead(F.lit(True)).over(w).isNull().alias("_last"),
        *[F.lag(c).over(w).alias(f"_in_{c}") for c in cols],
    )
    wk = Window.partitionBy(key).orderBy(BUCKET)
    carried = within.where("_last").select(
        F.col(key).alias("_k"), F.col(BUCKET).alias("_b"), *[F.lag(c).over(wk).alias(f"_carry_{c}") for c in cols]
    )
    out = [F.when(F.col("_rn") == 1, F.col(f"_carry_{c}")).otherwise(F.col(f"_in_{c}")).alias(f"prev_{c}") for c in cols]
    return _beside(within, carried, key).select(*df.columns, *out)


def number_by_key(df: DataFrame, key: str, order: list[str], bucket: Column, name: str = "step") -> DataFrame:
    """``df`` plus ``name`` = 1-based position of the row within its key in (order...) order (bigint). Same
    result as ``row_number() over (partition by key order by order...)``; ``bucket`` as in ``lag_by_key``."""
    bucketed = df.withColumn(BUCKET, bucket)
    within = bucketed.select("*", F.row_number().over(Window.partitionBy(key, BUCKET).orderBy(*order)).alias("_rn"))
    counts = bucketed.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key).alias("_k"), F.col(BUCKET).alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    return _beside(within, offsets, key).select(*df.columns, (F.col("_rn") + F.col("_off")).cast("bigint").alias(name))


def ordered_join_by_key(
    df: DataFrame, key: str, order: list[str], values: dict[str, str], bucket: Column, sep: str = ">"
) -> DataFrame:
    """One row per key with ``out = join(values[out] in (order...) order, sep)`` for each output name.

    Same result as ``array_join(transform(array_sort(collect_list(struct(order..., v))), ...), sep)`` per
    key, but built in pieces: the rows of a (key, bucket) become one string each, and the last step per key
    only concatenates those, one per bucket. Null values are skipped, as ``array_join`` does. ``bucket`` as in
    ``lag_by_key``."""
    item = F.struct(*[F.col(c) for c in order], *[F.col(v).alias(f"_v_{o}") for o, v in values.items()])
    pieces = df.withColumn(BUCKET, bucket).groupBy(key, BUCKET).agg(F.array_sort(F.collect_list(item)).alias("_items"))

    def piece(name: str) -> Column:
        kept = F.filter(F.transform("_items", _field(f"_v_{name}")), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, F.array_join(kept, sep)).alias(name)

    pieces = pieces.select(key, BUCKET, *[piece(o) for o in values])
    whole = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(BUCKET, *values))).alias("_pieces"))
    return whole.select(key, *[F.array_join(F.transform("_pieces", _field(o)), sep).alias(o) for o in values])


def _field(name: str):
    """One-argument lambda reading a struct field (PySpark reads a second argument as the index)."""
    return lambda x: x[name]
