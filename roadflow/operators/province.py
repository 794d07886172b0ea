"""Sightings per plate province (J5 G10; defect D12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Plate prefix -> province, in display order.
PROVINCES = [
    ("黑", "黑龙江"),
    ("京", "北京"),
    ("沪", "上海"),
    ("琼", "海南"),
    ("辽", "辽宁"),
    ("吉", "吉林"),
    ("闽", "福建"),
]
OTHER = "other"


def province_dim(spark: SparkSession) -> DataFrame:
    """The 7-row province dimension with its display order (fixed size, always safe to broadcast).
    Built as a JVM-side local relation (no Python-side rows to ship)."""
    rows = [
        F.struct(F.lit(p).alias("prefix"), F.lit(name).alias("province"), F.lit(i + 1).alias("ord"))
        for i, (p, name) in enumerate(PROVINCES)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def prefix_counts(flow: DataFrame) -> DataFrame:
    """Sightings per first plate character (F4 ``substring``); a partial aggregate, so at most one row per prefix and task
    leaves the map side."""
    return flow.groupBy(F.substring("plate", 1, 1).alias("prefix")).agg(F.count(F.lit(1)).alias("sightings"))


def fold_provinces(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Zero-filled counts of the 7 provinces in display order, plus one ``other`` row for every prefix
    outside the map (D12). ``counts`` has (prefix, sightings), one row per prefix.

    The prefix counts are mapped through the broadcast 7-row dimension (a left join, no shuffle of the
    counts); zero rows for the 8 display rows are unioned in and one small aggregate folds them."""
    dim = province_dim(spark)
    mapped = counts.join(F.broadcast(dim), "prefix", "left").select(
        F.coalesce("province", F.lit(OTHER)).alias("province"),
        F.coalesce("ord", F.lit(len(PROVINCES) + 1)).alias("ord"),
        F.col("sightings").cast("bigint").alias("sightings"),
    )
    other = spark.range(1).select(F.lit(OTHER).alias("province"), F.lit(len(PROVINCES) + 1).alias("ord"))
    zeros = dim.select("province", "ord").unionByName(other).withColumn("sightings", F.lit(0).cast("bigint"))
    return mapped.unionByName(zeros).groupBy("province", "ord").agg(F.sum("sightings").cast("bigint").alias("sightings"))


def province_counts(spark: SparkSession, flow: DataFrame) -> DataFrame:
    return fold_provinces(spark, prefix_counts(flow)).orderBy("ord")


def province_snapshot(counts: DataFrame) -> DataFrame:
    """``provinceList`` / ``provinceCount`` as ``|`` lists in display order (one row, 8 entries)."""
    r = counts.agg(F.array_sort(F.collect_list(F.struct("ord", "province", "sightings"))).alias("r"))
    return r.select(
        F.array_join(F.transform("r", lambda x: x["province"]), "|").alias("provinceList"),
        F.array_join(F.transform("r", lambda x: x["sightings"].cast("string")), "|").alias("provinceCount"),
    )
