"""Time helpers of the reference re-aimed as jobs over the flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.functions import columns as C
from roadflow.operators.sequence import lag_by_key
from roadflow.schemas import FLOW_COLUMNS, TIE_BREAK


def flow_by_hour(flow: DataFrame) -> DataFrame:
    """Sightings and distinct vehicles per ``yyyy-MM-dd_HH`` and block."""
    return flow.groupBy(C.date_hour("action_time").alias("date_hour"), F.col("block_id").alias("blockid")).agg(
        F.count(F.lit(1)).alias("sightings"), F.count_distinct("plate").alias("vehicles")
    )


def flow_by_5min(flow: DataFrame) -> DataFrame:
    """R2: sightings, vehicles and mean speed per 5-minute bucket and block, with the reference's label."""
    start = C.five_minute_start("action_time").cast("timestamp_ntz").alias("window_start")
    g = flow.groupBy(start, F.col("block_id").alias("blockid")).agg(
        F.count(F.lit(1)).alias("sightings"),
        F.count_distinct("plate").alias("vehicles"),
        F.round(F.avg("speed"), 3).alias("avg_speed"),
    )
    label = C.five_minute_label("window_start").alias("time_range")
    return g.select("window_start", label, "blockid", "sightings", "vehicles", "avg_speed")


def sighting_gap(flow: DataFrame) -> DataFrame:
    """Seconds since the same vehicle's previous sighting (null for its first one).

    Order: time, then the full tie-break, so it is the same on every run. The previous row is found with
    ``lag_by_key`` (windows per plate and day), so a vehicle with a huge number of sightings is spread over
    many tasks instead of one window partition."""
    rows = flow.select("plate", "action_time", *TIE_BREAK)
    with_prev = lag_by_key(rows, "plate", ["action_time", *TIE_BREAK], ["action_time", "block_id"], F.to_date("action_time"))
    return with_prev.select(
        "plate",
        "action_time",
        F.col("block_id").alias("blockid"),
        F.col("prev_action_time").alias("prev_time"),
        F.col("prev_block_id").alias("prev_blockid"),
        C.seconds_between("action_time", "prev_action_time").alias("gap_seconds"),
    )


def flow_between(flow: DataFrame, lo: str, hi: str) -> DataFrame:
    """Sightings strictly after ``lo`` and strictly before ``hi``; a null time is outside. The bounds are
    typed literals so the predicate reaches the scan as a pushed filter when the flow is stored."""
    lo_t = F.lit(lo).cast("timestamp_ntz")
    hi_t = F.lit(hi).cast("timestamp_ntz")
    return flow.where((F.col("action_time") > lo_t) & (F.col("action_time") < hi_t)).select(*FLOW_COLUMNS)


def date_keys(flow: DataFrame) -> DataFrame:
    """The four text keys of each sighting, for partitioned output (``write.partitionBy('date_key')``)."""
    t = F.col("action_time")
    return flow.select(
        "plate",
        F.col("block_id").alias("blockid"),
        "monitor_id",
        "action_time",
        C.date_key(t).alias("date_key"),
        F.date_format(t, "yyyy-MM-dd").alias("date_text"),
        F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("time_text"),
        C.minute_key(t).alias("minute_key"),
        C.parse_date_key(C.date_key(t)).alias("date_key_parsed"),
    )


def flow_day_slice(flow: DataFrame, run_date: str | None = None, days_back: int = 1) -> DataFrame:
    """The sightings of the day ``days_back`` before the run date (yesterday by default; 0 = today).
    Filtering on ``create_date`` lets a date-partitioned flow prune to one partition."""
    rd = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return flow.where(F.col("create_date") == F.date_sub(rd, days_back)).select(*FLOW_COLUMNS)
