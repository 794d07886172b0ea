"""Device status: which registered cameras of each block produced no sightings.

Operators G2 G4 G5 J1 J2 O1 F10, defects D6 D7 D8. Results are aggregates returned as DataFrames, never
values gathered in driver variables (D9); column selection replaces the key-by projections (P2) and each
result is shaped by one ``select`` with the reference's column names (P7). The reference groups whole blocks with ``groupByKey`` and
diff-s sets inside one row; here every step is a key-level join or a partial aggregate, so no block's
rows are ever gathered in one place -- only the per-block camera lists that form the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _run_date(run_date: str | None) -> F.Column:
    """The run date stamped on results; a literal parameter so reruns repeat, else ``current_date()``."""
    return F.current_date() if run_date is None else F.lit(run_date).cast("date")


def device_status(flow: DataFrame, registry: DataFrame, run_date: str | None = None) -> DataFrame:
    """One row per registered block over the whole observed log (result table ``monitor_state``; J1 G2 G4
    G5). online = registered and seen (D7); a block with no sightings has every camera offline (D6).

    Everything is at camera grain: sightings are reduced to distinct cameras by a hash aggregate before
    the shuffle, joined to the registered ones, and counted. Only the offline cameras, which are the output,
    are listed."""
    j = _registered(registry).join(_seen(flow), ["block_id", "monitor_id"], "left")
    offline = F.array_sort(F.collect_list(F.when(F.col("seen").isNull(), F.col("monitor_id"))))
    counts = j.groupBy("block_id").agg(
        F.count(F.lit(1)).alias("registered"), F.count("seen").alias("online"), offline.alias("offline")
    )
    return counts.select(
        _run_date(run_date).alias("create_date"),
        F.col("block_id").alias("blockid"),
        F.col("registered").alias("monitor_standard_count"),
        F.col("online").alias("normal_monitor_count"),
        (F.col("registered") - F.col("online")).alias("abnormal_monitor_count"),
        F.array_join("offline", ",").alias("abnormal_monitor_camera_infos"),
    ).orderBy("create_date", "blockid")


def _registered(registry: DataFrame) -> DataFrame:
    return registry.select("block_id", "monitor_id").distinct()


def _seen(flow: DataFrame, *more: str) -> DataFrame:
    """The cameras with sightings (per ``more`` columns, if any), each once."""
    return flow.select(*more, "block_id", "monitor_id").distinct().withColumn("seen", F.lit(True))


def device_status_daily(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """Device status counts per day and block, for every (day, block) with at least one sighting. The
    cameras behind the counts are in ``offline_cameras_daily``, as stretches of days: a list of silent
    cameras per day would grow with days times cameras."""
    reg = _registered(registry)
    seen = _seen(flow, "create_date").join(reg.withColumn("known", F.lit(True)), ["block_id", "monitor_id"], "left")
    daily = seen.groupBy("create_date", "block_id").agg(F.count("known").alias("online"))
    sizes = reg.groupBy("block_id").agg(F.count(F.lit(1)).alias("registered"))
    j = daily.join(sizes, "block_id", "left").withColumn("registered", F.coalesce("registered", F.lit(0).cast("bigint")))
    return j.select(
        "create_date",
        F.col("block_id").alias("blockid"),
        F.col("registered").alias("monitor_standard_count"),
        F.col("online").alias("normal_monitor_count"),
        (F.col("registered") - F.col("online")).alias("abnormal_monitor_count"),
    )


def offline_cameras(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered cameras never seen in the log (J2, anti join at camera grain)."""
    reg = registry.select("block_id", "monitor_id").distinct()
    seen = flow.select("block_id", "monitor_id").distinct()  # partial dedup before the shuffle
    return reg.join(seen, ["block_id", "monitor_id"], "left_anti").select(
        F.col("block_id").alias("blockid"), "monitor_id"
    )


def offline_cameras_daily(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """(block, camera, silent_from, silent_to, silent_days): the stretches of a block's active days (those
    with sightings) on which a registered camera had none.

    A stretch lies between two days on which the camera was seen, so there is at most one per camera and
    day seen, plus one per camera: the result grows with the sightings, not with days times cameras. The
    days of a block are numbered; a camera's stretches are the gaps in its numbers, with a last number after
    the block's last day for cameras that end silent or were never seen."""
    seen = _seen(flow, "create_date")
    order = Window.partitionBy("block_id").orderBy("create_date")
    days = seen.select("block_id", "create_date").distinct().withColumn("n", F.row_number().over(order))
    reg = _registered(registry)
    on = seen.join(reg, ["block_id", "monitor_id"], "left_semi").join(days, ["block_id", "create_date"])
    after = days.groupBy("block_id").agg((F.max("n") + 1).alias("n"))
    points = on.select("block_id", "monitor_id", "n").unionByName(reg.join(after, "block_id"))
    before = F.coalesce(F.lag("n").over(Window.partitionBy("block_id", "monitor_id").orderBy("n")), F.lit(0))
    gaps = points.select("block_id", "monitor_id", (before + 1).alias("lo"), (F.col("n") - 1).alias("hi")).where("lo <= hi")
    day = lambda n, name: days.select("block_id", F.col("n").alias(n), F.col("create_date").alias(name))
    return gaps.join(day("lo", "silent_from"), ["block_id", "lo"]).join(day("hi", "silent_to"), ["block_id", "hi"]).select(
        F.col("block_id").alias("blockid"), "monitor_id", "silent_from", "silent_to", (F.col("hi") - F.col("lo") + 1).cast("bigint").alias("silent_days")
    )


def unregistered_cameras(flow: DataFrame, registry: DataFrame) -> DataFrame:
    """Cameras that produced sightings but are not in the registry (D7), with their sighting span."""
    reg = registry.select("block_id", "monitor_id").distinct()
    # Aggregate per camera first (partial, map-side), so the anti join sees one row per camera seen,
    # not one per sighting.
    per_camera = flow.groupBy("block_id", "monitor_id").agg(
        F.count(F.lit(1)).alias("sightings"),
        F.min("action_time").alias("first_seen"),
        F.max("action_time").alias("last_seen"),
    )
    return per_camera.join(reg, ["block_id", "monitor_id"], "left_anti").withColumnRenamed("block_id", "blockid")


def device_chart(status: DataFrame) -> DataFrame:
    """Chart snapshot: block ids, broken counts and camera totals as ``|`` lists in block order (D8:
    each count in its named column). One row; its size is bounded by the number of blocks."""
    rows = F.array_sort(
        F.collect_list(F.struct("blockid", "abnormal_monitor_count", "monitor_standard_count"))
    )
    packed = status.agg(rows.alias("r"))
    return packed.select(
        F.array_join(F.transform("r", lambda x: x["blockid"]), "|").alias("blockid"),
        F.array_join(F.transform("r", lambda x: x["abnormal_monitor_count"].cast("string")), "|").alias(
            "brokenCount"
        ),
        F.array_join(F.transform("r", lambda x: x["monitor_standard_count"].cast("string")), "|").alias(
            "monitorSum"
        ),
    )


def device_web(status: DataFrame) -> DataFrame:
    """Web snapshot ``(block,count|cam,cam)>(…)`` in block order, one row per run date."""
    item = F.format_string(
        "(%s,%s|%s)", F.col("blockid"), F.col("abnormal_monitor_count"), F.col("abnormal_monitor_camera_infos")
    )
    r = status.groupBy("create_date").agg(F.array_sort(F.collect_list(F.struct("blockid", item.alias("t")))).alias("r"))
    return r.select("create_date", F.array_join(F.transform("r", lambda x: x["t"]), ">").alias("blockMonitor"))
