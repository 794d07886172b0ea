"""Derived sighting tables over the driver's test tables (FIXTURES.md §2), built with the DataFrame API.

The oracle side (``roadflow.plans.oracle``) states the same views in SQL; the two are written
independently so a mistake in one shows up as a mismatch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.session import configure

# Fixed values of the fixture (must stay as written): plate province letter chosen by key % 10 from this
# ten-character string, and the out-of-map letter used when key % 50 == 13.
PLATE_LETTERS = "黑黑黑京沪琼黑辽吉闽"
OUTSIDE_LETTER = "粤"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plate_of(key: Column) -> Column:
    """Plate text for a numeric owner key: province letter + A-Z + five-digit number."""
    province = F.when(key % 50 == 13, F.lit(OUTSIDE_LETTER)).otherwise(
        F.substr(F.lit(PLATE_LETTERS), (key % 10).cast("int") + 1, F.lit(1))
    )
    return F.concat(province, F.char((key % 26 + 65).cast("int")), F.lpad(key.cast("string"), 5, "0"))


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch sightings: one per lineitem, owner from its order (view ``flow``)."""
    configure(spark)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_partkey", "l_quantity"
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # No hint: the planner and AQE pick the join from the sizes they see (a sort-merge join spills).
    j = li.join(orders, "l_orderkey")
    offset = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3571) % 86400
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        F.to_date("l_shipdate").alias("create_date"),
        F.lpad((F.col("l_suppkey") % 9).cast("string"), 4, "0").alias("block_id"),
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("monitor_id"),
        plate_of(F.col("o_custkey")).alias("plate"),
        F.timestamp_add("SECOND", offset, F.col("l_shipdate")).alias("action_time"),
        (F.col("l_quantity").cast("int") * 3 - 3).alias("speed"),
        F.col("l_partkey").cast("string").alias("road_id"),
        F.lpad((F.col("l_partkey") % 25).cast("string"), 2, "0").alias("area_id"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered cameras (view ``registry``): one seen camera in ten is left out, and one supplier in ten
    each gives a camera that never sights anything, in a block with sightings and in block ``0009``, which has
    none."""
    key = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    block, camera = F.lpad((key % 9).cast("string"), 4, "0"), F.lpad(key.cast("string"), 5, "0")
    silent = F.concat(F.lit("N"), camera)
    both = lambda b, c: F.struct(b.alias("block_id"), c.alias("monitor_id"))
    cameras = F.array(
        F.when(key % 10 != 7, both(block, camera)),
        F.when(key % 10 == 3, both(block, silent)),
        F.when(key % 10 == 4, both(F.lit("0009"), silent)),
    )
    return s.select(F.inline(F.filter(cameras, lambda c: c.isNotNull())))


def district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts (view ``district``): every nation but one in eight, so that some areas have no name."""
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 8 != 5)
    return n.select(F.col("n_nationkey").alias("district_id"), F.col("n_name").alias("district_name"))


def road(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads (view ``road``): every part but one in 25, so that some roads have no name."""
    p = table(spark, sf_dir, "part").where(F.col("p_partkey") % 25 != 0)
    return p.select(F.col("p_partkey").alias("road_id"), F.col("p_name").alias("road_name"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested / watched plates (view ``requests``)."""
    c = table(spark, sf_dir, "customer").where((F.col("c_custkey") % 50).isin(3, 13))
    return c.select(plate_of(F.col("c_custkey")).alias("plate"))


def events_to_flow(events: DataFrame) -> DataFrame:
    """Sightings from the ``events`` table (view ``flow_events``); works on batch and streaming frames."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return events.select(
        "event_id",
        F.col("ts").alias("action_time"),
        F.col("ts").alias("arrival_time"),
        F.to_date("ts").alias("create_date"),
        F.lpad((F.col("user_id") % 9).cast("string"), 4, "0").alias("block_id"),
        F.lpad((F.col("event_id") % 100).cast("string"), 5, "0").alias("monitor_id"),
        plate_of(F.col("user_id")).alias("plate"),
        (F.floor(F.col("value") * 10).cast("int") % 140).alias("speed"),
        (k % 50 + 1).cast("string").alias("road_id"),
        F.lpad((k % 8).cast("string"), 2, "0").alias("area_id"),
    )


def flow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return events_to_flow(table(spark, sf_dir, "events"))
