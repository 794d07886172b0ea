"""Non-local vehicles: every inbound sighting, the first sighting per vehicle, and daily totals
(P4 O4 G13; defects D14 D21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.schemas import TIE_BREAK

# Default local plate prefix of the batch job (province letter); the streaming totals use the city
# prefix (D21). Both are parameters.
LOCAL_PREFIX = "黑"


def non_local(flow: DataFrame, local_prefix: str = LOCAL_PREFIX) -> DataFrame:
    """Plate does not start with the local prefix (character-wise, plates are multi-byte)."""
    return flow.where(~F.col("plate").startswith(local_prefix))


def inbound_sightings(flow: DataFrame, local_prefix: str = LOCAL_PREFIX) -> DataFrame:
    """Result table ``Inbound_Auto``: all non-local sightings in time order (O4). The reference puts the
    area in ``roadid``; both road and area are kept here (D14)."""
    rows = non_local(flow, local_prefix).select(
        F.col("action_time").alias("inbound_date"),
        "plate",
        F.col("block_id").alias("first_inbound_position"),
        F.col("road_id").alias("roadid"),
        F.col("area_id").alias("areaid"),
        "monitor_id",
        "speed",
    )
    return rows.orderBy("inbound_date", "first_inbound_position", "monitor_id", "roadid", "areaid", "speed", "plate")


def inbound_first_seen(flow: DataFrame, local_prefix: str = LOCAL_PREFIX) -> DataFrame:
    """Each non-local vehicle's first sighting (position = block, road, area of it) and its number
    of sightings.

    The first time and the count are a hash aggregate (partial, so a vehicle with very many sightings is
    reduced map-side). Only the sightings at that time, one per vehicle but for ties, go through the
    tie-break, which needs a sort aggregate."""
    rows = non_local(flow, local_prefix)
    firsts = rows.groupBy("plate").agg(F.min("action_time").alias("first_time"), F.count(F.lit(1)).alias("sightings"))
    at_first = rows.join(firsts.withColumnRenamed("plate", "_p"), (F.col("plate") == F.col("_p")) & F.col("action_time").eqNullSafe(F.col("first_time")))
    agg = at_first.groupBy("plate", "sightings").agg(F.min(F.struct("action_time", *TIE_BREAK)).alias("f"))
    return agg.select(
        "plate",
        F.col("f.action_time").alias("first_time"),
        F.col("f.block_id").alias("first_inbound_position"),
        F.col("f.road_id").alias("roadid"),
        F.col("f.area_id").alias("areaid"),
        "sightings",
    )


def inbound_summary(flow: DataFrame, local_prefix: str = LOCAL_PREFIX) -> DataFrame:
    """Per day: non-local sightings, distinct non-local vehicles, and vehicles first seen that day.

    One pass over the sightings: a (plate, day) pre-aggregate (partial, so a hot plate is reduced
    map-side) feeds both the daily counts and each vehicle's first sighting."""
    per_plate_day = non_local(flow, local_prefix).groupBy("plate", "create_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("action_time").alias("first_time")
    )
    daily = per_plate_day.groupBy("create_date").agg(
        F.sum("n").cast("bigint").alias("inbound_sightings"), F.count(F.lit(1)).alias("inbound_vehicles")
    )
    firsts = (
        per_plate_day.groupBy("plate")
        .agg(F.min("first_time").alias("first_time"))
        .groupBy(F.to_date("first_time").alias("create_date"))
        .agg(F.count(F.lit(1)).alias("new_vehicles"))
    )
    return daily.join(firsts, "create_date", "left").select(
        "create_date",
        "inbound_sightings",
        "inbound_vehicles",
        F.coalesce("new_vehicles", F.lit(0).cast("bigint")).alias("new_vehicles"),
    )
