"""Keyed streaming operators whose state expires: watch messages joined with sightings (J6 S6), each inbound vehicle
reported once (G13 T3), and running state read back from the checkpoint (G8 G10 T3).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadflow.operators.inbound import LOCAL_PREFIX, non_local
from roadflow.schemas import TIE_BREAK
from roadflow.streaming.sources import event_time

# --- watch messages x sightings (J6 S6) ----------------------------------------------------------------------


def watched_sightings(
    flow: DataFrame, watch: DataFrame, within: str = "1 hour", delay: str = "10 minutes", time: str = "action_time"
) -> DataFrame:
    """Two-sided stream join: a row per watch message (``plate``, ``asked_at``) and sighting of that plate from
    ``asked_at`` to ``within`` later. The list arrives on its own subscription and may change at any time.

    Both sides carry a watermark of ``delay``. A message stays in the state until sightings have passed its
    interval; a sighting stays only until no message can be that early any more. So the state holds ``within`` plus
    ``delay`` of messages and ``delay`` of sightings, whatever the stream has seen. Rows that come later than
    ``delay`` behind their own stream are dropped, as Spark's watermark has it."""
    seen = event_time(flow, time).withWatermark("event_ts", delay)
    asked = watch.where(F.length("plate") > 0).select(
        F.col("plate").alias("asked_plate"), F.col("asked_at").cast("timestamp").alias("asked_ts")
    )
    asked = asked.withWatermark("asked_ts", delay)
    on = (
        (F.col("plate") == F.col("asked_plate"))
        & (F.col("event_ts") >= F.col("asked_ts"))
        & (F.col("event_ts") <= F.col("asked_ts") + F.expr(f"interval {within}"))
    )
    return seen.join(asked, on, "inner").select(
        "plate",
        F.col("asked_ts").cast("timestamp_ntz").alias("asked_at"),
        F.col("event_ts").cast("timestamp_ntz").alias("time"),
        F.col("block_id").alias("blockid"),
        F.col("road_id").alias("roadid"),
        F.col("area_id").alias("areaid"),
    )


# --- first sightings (G13 T3) ------------------------------------------------------------------------------------

FIRST = "plate string, first_time timestamp_ntz, first_inbound_position string, roadid string, areaid string"


def _earliest(plate: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Report a vehicle whose plate is not in the state, by its earliest sighting of the batch. The state is the
    vehicle's last time in milliseconds."""
    if state.hasTimedOut:
        state.remove()
        return
    first, last, keep = None, state.get[0] if state.exists else 0, 0
    for rows in batches:
        earliest = rows.sort_values(["event_ts", *TIE_BREAK], na_position="first").iloc[:1]
        first = earliest if first is None else pd.concat([first, earliest]).sort_values(["event_ts", *TIE_BREAK], na_position="first").iloc[:1]
        last = max(last, int(rows["event_ts"].max().timestamp() * 1000))
        keep = int(rows["keep_ms"].iloc[0])
    if not state.exists:
        out = first[["event_ts", "block_id", "road_id", "area_id"]].set_axis(["first_time", "first_inbound_position", "roadid", "areaid"], axis=1)
        out.insert(0, "plate", plate[0])
        yield out
    state.update((last,))
    state.setTimeoutTimestamp(max(last + keep, state.getCurrentWatermarkMs() + 1))


def first_sightings(flow: DataFrame, keep: str = "30 days", delay: str = "10 minutes", local_prefix: str = LOCAL_PREFIX, time: str = "action_time") -> DataFrame:
    """Each non-local vehicle once: a row when its plate is first seen, with the time and place of that sighting
    (of several in one batch the earliest, ties by block, camera, road, area, speed). A plate leaves the state
    when the watermark is ``keep`` past its last sighting, and is reported again when it then comes back; so
    the state is as large as the vehicles of the last ``keep``, not of all time.

    The state keeps a time per plate. Grouping is by plate; a vehicle's rows of a batch are read in Arrow batches,
    never held together."""
    rows = event_time(non_local(flow, local_prefix), time).withWatermark("event_ts", delay)
    ms = F.expr(f"unix_millis(timestamp_seconds(0) + interval {keep})").alias("keep_ms")
    kept = rows.select("plate", "event_ts", *TIE_BREAK, ms)
    return kept.groupBy("plate").applyInPandasWithState(_earliest, FIRST, "last bigint", "append", GroupStateTimeout.EventTimeTimeout)


# --- running state from the checkpoint (G8 G10 T3) ----------------------------------------------------------------


def running_state(spark: SparkSession, checkpoint: str, keys: str, values: str, operator: int = 0) -> DataFrame:
    """The state of a stateful query as of its last committed batch, read from its checkpoint by Spark's state
    reader: one row per key with the aggregate's buffers. ``keys`` and ``values`` name and type both, in order, as
    fields of a struct type. The cost is that of the state, however many batches made it."""
    rows = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint)
    sides = [(side, fields) for side, fields in (("key", keys), ("value", values)) if fields]
    typed = rows.select(*[F.col(side).cast(f"struct<{fields}>").alias(side) for side, fields in sides])
    return typed.select(*[f"{side}.*" for side, _ in sides])


def running_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals of a ``totals_stream`` query."""
    return running_state(spark, checkpoint, "", "current_auto_count: bigint, current_inbound_auto: bigint")


def running_prefixes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts of a ``province_prefix_stream`` query."""
    return running_state(spark, checkpoint, "prefix: string", "sightings: bigint")


def running_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The window means of a ``window_speed_stream`` query that its watermark has not closed yet."""
    rows = running_state(spark, checkpoint, "w: struct<start: timestamp, end: timestamp>, blockid: string", "speed_sum: bigint, speed_count: bigint, sightings: bigint")
    bounds = [F.col(f"w.{side}").cast("timestamp_ntz").alias(f"window_{side}") for side in ("start", "end")]
    return rows.select(*bounds, "blockid", F.expr("speed_sum div speed_count").alias("avg_speed"), "sightings")
