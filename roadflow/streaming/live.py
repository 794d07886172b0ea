"""Live jobs over the sighting stream.

Each ``*_stream`` function returns the streaming DataFrame (the plan); ``start_*`` functions attach a sink
and start it. State is bounded everywhere: the sliding mean has a watermark, the totals and province counts
keep one row per key of a fixed small key set, and the event-time form keeps none.

Windows run on arrival time by default, as the reference's do (T2): arrival moves forward, so no sighting is
late. The event-time form adds up per-batch partial sums instead of holding a watermark, so a sighting that
arrives long after its time still counts in its window.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.operators import province as prov
from roadflow.operators.track import vehicle_track, vehicle_track_named
from roadflow.session import list_names, path_exists, remove_path
from roadflow.sinks.tables import write_json_lines
from roadflow.streaming.sources import event_time

# Reference defaults (T1 T2): 10 s batches, 20 s windows sliding by 10 s; 5 s batches for alerts.
SPEED_TRIGGER = "10 seconds"
ALERT_TRIGGER = "5 seconds"
WINDOW = "20 seconds"
SLIDE = "10 seconds"
SPEED_KEYS = ["window_start", "window_end", "blockid"]
COMPACT = "_compact"


def _by_window(flow: DataFrame, size: str, slide: str):
    return flow.groupBy(F.window("event_ts", size, slide).alias("w"), F.col("block_id").alias("blockid"))


def _window_columns(g: DataFrame, *more: str) -> DataFrame:
    """Window bounds as wall-clock ``timestamp_ntz`` like the input."""
    bounds = [F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end")]
    return g.select(*bounds, "blockid", *more)


def window_speed_stream(
    flow: DataFrame, size: str = WINDOW, slide: str = SLIDE, watermark: str = "1 hour", time: str = "arrival_time"
) -> DataFrame:
    """Integer mean speed (``sum div count`` of the speeds there are) per block and sliding window,
    over the speed field (D10).

    ``time`` is the column the windows run on: arrival by default. On an event time the watermark bounds the
    state and Spark drops rows older than it; ``start_event_windows`` is the form that keeps them."""
    ev = event_time(flow, time).withWatermark("event_ts", watermark)
    g = _by_window(ev, size, slide).agg(F.expr("sum(speed) div count(speed)").alias("avg_speed"), F.count(F.lit(1)).alias("sightings"))
    return _window_columns(g, "avg_speed", "sightings")


def window_partials(flow: DataFrame, size: str = WINDOW, slide: str = SLIDE, time: str = "action_time") -> DataFrame:
    """Sums and counts per block and window of a batch of sightings; partials of one window add up."""
    g = _by_window(event_time(flow, time), size, slide).agg(
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"), F.count(F.lit(1)).alias("sightings")
    )
    return _window_columns(g, "speed_sum", "speed_count", "sightings")


def start_event_windows(
    flow: DataFrame, out_path: str, checkpoint: str, size: str = WINDOW, slide: str = SLIDE, trigger: dict | None = None
):
    """G9 over event time without loss: every micro-batch writes its own window partials. Late sightings are
    partials like any other; no state is held. Read with ``read_event_windows``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(window_partials(batch, size, slide), out_path, batch_id)

    w = flow.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": SPEED_TRIGGER}))
    return w.foreachBatch(handle).start()


def read_event_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """Window means from the partials written so far."""
    sums = _added_up(current_rows(spark, out_path))
    return sums.select(*SPEED_KEYS, F.expr("speed_sum div speed_count").alias("avg_speed"), "sightings")


def _added_up(partials: DataFrame, keys: list[str] = SPEED_KEYS) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("speed_sum", "speed_count", "sightings")])


def totals_stream(flow: DataFrame, local_prefix: str = "黑A") -> DataFrame:
    """Running count of all sightings and of non-local ones (city prefix by default, D21).
    A global aggregate: state is one row. Needs a plate only."""
    return flow.agg(
        F.count(F.lit(1)).alias("current_auto_count"),
        F.count_if(~F.col("plate").startswith(local_prefix)).alias("current_inbound_auto"),
    )


def province_prefix_stream(flow: DataFrame) -> DataFrame:
    """Running sightings per first plate character (state: one row per prefix). Needs a plate only."""
    return prov.prefix_counts(flow)


def alerts_stream(flow: DataFrame, watch: DataFrame) -> DataFrame:
    """One alert row per sighting of a watched plate (stream-static semi join; the planner
    broadcasts the watch list when its size allows). The result table's columns (``create_time`` is the line's
    date), with real block and road (D15), any number of watched plates (D16), and beside them the message's
    ``HH:mm`` and the area."""
    hits = flow.join(watch.where(F.length("plate") > 0).select("plate").distinct(), "plate", "left_semi")
    return hits.select(
        F.col("create_date").alias("create_time"),
        "plate",
        F.col("block_id").alias("blockid"),
        F.col("action_time").alias("time"),
        F.col("road_id").alias("roadid"),
        F.col("area_id").alias("areaid"),
        F.date_format("action_time", "HH:mm").alias("alert_time"),
    )


# --- sinks for the live jobs -------------------------------------------------------------------------

@contextmanager
def state_partitions_for_start(spark: SparkSession, n: int | None):
    """Shuffle width a stateful query starts with. Spark fixes a streaming aggregate's number of state
    partitions from ``spark.sql.shuffle.partitions`` when the query first starts, and records it in the
    checkpoint. Size it to the state (keys alive under the watermark), not to the input volume. ``None``
    keeps the session's value."""
    if n is None:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _write_batch(batch: DataFrame, out_path: str, batch_id: int) -> None:
    """A micro-batch's rows to its own ``batch_id=N`` folder with overwrite, so a replayed batch replaces its
    own output instead of appending twice."""
    batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")


def start_to_table(
    stream: DataFrame,
    out_path: str,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
    after=None,
):
    """Start ``stream`` with a per-batch idempotent parquet sink (K3) and its checkpoint (T4). ``trigger`` e.g.
    ``{"processingTime": "10 seconds"}`` (default) or ``{"availableNow": True}``; ``state_partitions`` see
    ``state_partitions_for_start``; ``after()``, if given, runs when a batch is written."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, out_path, batch_id)
        if after is not None:
            after()

    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": SPEED_TRIGGER}))
    with state_partitions_for_start(stream.sparkSession, state_partitions):
        return w.foreachBatch(handle).start()


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The N of the folders ``prefix=N`` below ``path`` that are completely written, ascending."""
    names = [n for n in list_names(spark, path) if n.startswith(f"{prefix}=")]
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def current_rows(spark: SparkSession, out_path: str, upto: int | None = None) -> DataFrame | None:
    """All rows of a per-batch output with their ``batch_id``: the newest compacted table, if there is one, and
    the batches written completely since (to batch ``upto`` if given). None if there is nothing."""
    base = out_path.rstrip("/")
    folded = _numbers(spark, f"{base}/{COMPACT}", "upto")
    newer = [n for n in _numbers(spark, base, "batch_id") if (not folded or n > folded[-1]) and (upto is None or n <= upto)]
    parts = []
    if folded:
        parts.append(spark.read.parquet(f"{base}/{COMPACT}/upto={folded[-1]}"))
    if newer:
        rows = spark.read.option("basePath", base).parquet(*[f"{base}/batch_id={n}" for n in newer])
        parts.append(rows.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    value_cols = [c for c in rows.columns if c not in keys and c != "batch_id"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*value_cols, "batch_id"), "batch_id").alias("v"))
    return latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in [*value_cols, "batch_id"]])


def latest_rows(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """Final state of an update- or complete-mode output: for each key, the row of the latest batch. Without
    keys (a global aggregate) every batch holds the whole state, so only the newest is read."""
    base = out_path.rstrip("/")
    if not keys:
        return spark.read.parquet(f"{base}/batch_id={_numbers(spark, base, 'batch_id')[-1]}")
    rows = current_rows(spark, base)
    if rows is None:
        raise FileNotFoundError(f"no complete batch below this path: {base}")
    return _latest(rows, keys).drop("batch_id")


def compact(
    spark: SparkSession,
    out_path: str,
    keys: list[str] | None,
    remove: bool = False,
    sum_keys: list[str] = SPEED_KEYS,
    upto: int | None = None,
) -> int:
    """Fold the batches written since the last compaction (to batch ``upto`` if given) into a new table beside
    them: the latest row per key, or, with ``keys=None``, partial sums added up per ``sum_keys``. Only the last
    compacted table and newer batches are read, readers (``current_rows``) take the newest complete table plus the
    batches after it, and ``remove`` deletes what it replaces. Returns the number of batches folded; run it from one
    place at a time."""
    base = out_path.rstrip("/")
    folded = _numbers(spark, f"{base}/{COMPACT}", "upto")
    batches = [n for n in _numbers(spark, base, "batch_id") if upto is None or n <= upto]
    fresh = [n for n in batches if not folded or n > folded[-1]]
    if not fresh:
        return 0
    rows = current_rows(spark, base, fresh[-1])
    last = F.lit(fresh[-1]).cast("bigint")
    whole = _latest(rows, keys) if keys is not None else _added_up(rows, sum_keys).withColumn("batch_id", last)
    whole.hint("rebalance").write.mode("overwrite").parquet(f"{base}/{COMPACT}/upto={fresh[-1]}")
    if remove:
        for n in batches:
            remove_path(spark, f"{base}/batch_id={n}")
        for n in folded:
            remove_path(spark, f"{base}/{COMPACT}/upto={n}")
    return len(fresh)


def start_append(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Rows appended as parquet files by Spark's file sink, each once."""
    w = stream.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": ALERT_TRIGGER})).start()


def start_alerts(flow: DataFrame, watch: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Alerts appended as parquet files (exactly-once file sink), for a watch list that does not change."""
    return start_append(alerts_stream(flow, watch), out_path, checkpoint, trigger)


def start_track_requests(
    read_flow,
    requests: DataFrame,
    out_path: str,
    checkpoint: str,
    run_date: str | None = None,
    trigger: dict | None = None,
    read_dimensions=None,
    json_path: str | None = None,
    for_requests=None,
):
    """Each micro-batch of requested plates runs one track job (one semi join for the whole batch of
    requests) over the log as ``read_flow()`` returns it at that moment, so sightings stored between two requests
    are in the second answer. ``read_dimensions()``, if given, returns (district, road) and the routes carry
    names. Routes go to the batch's folder and, with ``json_path``, as one JSON document per route too.
    ``for_requests(requests)``, if given, returns the log narrowed to the requests (``track_store.stored_sightings``)
    and is used instead of ``read_flow``."""

    def handle(reqs: DataFrame, batch_id: int) -> None:
        asked = reqs.persist()  # the plates are used by the plan more than once
        flow = for_requests(asked) if for_requests is not None else read_flow()
        if read_dimensions is None:
            routes = vehicle_track(flow, asked, run_date)
        else:
            routes = vehicle_track_named(flow, asked, *read_dimensions(), run_date)
        _write_batch(routes, out_path, batch_id)
        if json_path:
            written = routes.sparkSession.read.schema(routes.schema).parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
            write_json_lines(written, f"{json_path.rstrip('/')}/batch_id={batch_id}")
        asked.unpersist()

    return (
        requests.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ALERT_TRIGGER}))
        .foreachBatch(handle)
        .start()
    )


def run_available_now(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    keys: list[str] | None,
    output_mode: str = "update",
    state_partitions: int | None = None,
) -> DataFrame:
    """Drive ``stream`` over everything available now (fresh checkpoint and output under the shared
    folder, one per call) and return its final result as a batch DataFrame. ``keys`` = grouping keys of
    an update/complete-mode aggregate (latest row per key); ``None`` = append output, all rows."""
    from roadflow.session import scratch_path

    out = scratch_path(spark, f"{name}-out")
    ck = scratch_path(spark, f"{name}-ckpt")
    if keys is None:
        with state_partitions_for_start(spark, state_partitions):
            q = (
                stream.writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", ck)
                .trigger(availableNow=True).start()
            )
    else:
        q = start_to_table(stream, out, ck, output_mode, {"availableNow": True}, state_partitions=state_partitions)
    q.awaitTermination()
    if not path_exists(spark, out) or not [n for n in list_names(spark, out) if not n.startswith("_")]:
        return spark.createDataFrame([], stream.schema)  # the stream had no input
    if keys is None:
        return spark.read.schema(stream.schema).parquet(out)
    return latest_rows(spark, out, keys).select(*stream.columns)


# --- the reference's live job as one unit (T5 T9) and its snapshot outputs (D13, K3) -----------------

def latest_window(window_speeds: DataFrame) -> DataFrame:
    """The rows of the newest window."""
    return window_speeds.where(F.col("window_start") == window_speeds.agg(F.max("window_start")).scalar())


def speed_rank(window_speeds: DataFrame) -> DataFrame:
    """Per window, blocks ranked by mean speed desc (ties by block): ``blockRank`` and ``speedRank`` as
    ``|`` lists and ``speedList`` as ``(block,mean)>(…)``. One row per window; each list is bounded by the
    number of blocks."""
    r = window_speeds.groupBy("window_start", "window_end").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("avg_speed")).alias("k"), "blockid", "avg_speed"))).alias("r")
    )
    return r.select(
        "window_start",
        "window_end",
        F.array_join(F.transform("r", lambda x: x["blockid"]), "|").alias("blockRank"),
        F.array_join(F.transform("r", lambda x: x["avg_speed"].cast("string")), "|").alias("speedRank"),
        F.array_join(F.transform("r", lambda x: F.format_string("(%s,%s)", x["blockid"], x["avg_speed"].cast("string"))), ">").alias("speedList"),
    )


def totals_with_ranking(totals: DataFrame, window_speeds: DataFrame, run_date: str | None) -> DataFrame:
    """One row: run date, running totals, and the ranking of the latest window (``l``)."""
    ranks = speed_rank(latest_window(window_speeds))
    rd = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return totals.select(
        rd.alias("create_date"),
        F.col("current_auto_count").alias("currentAutoCount"),
        F.col("current_inbound_auto").alias("currentInboundAuto"),
        ranks.select(F.struct("window_start", "blockRank", "speedRank", "speedList")).scalar().alias("l"),
    )


def live_snapshot(totals: DataFrame, window_speeds: DataFrame, run_date: str | None = None) -> DataFrame:
    """Live snapshot row: run date, running totals and the ranking of the latest window, which is picked
    before anything is ranked. ``totals`` has one row."""
    row = totals_with_ranking(totals, window_speeds, run_date)
    return row.select("create_date", "currentAutoCount", "currentInboundAuto", "l.window_start", "l.blockRank", "l.speedRank")


def web_columns() -> list:
    """The web document's columns, from the row of ``totals_with_ranking``."""
    return ["create_date", "currentAutoCount", "currentInboundAuto", F.col("l.speedList").alias("speedRank")]


def chart_columns() -> list:
    """The chart document's; ``currenAutoCount`` is spelt as the chart reads it."""
    return ["create_date", F.col("currentAutoCount").alias("currenAutoCount"), "currentInboundAuto", "l.blockRank", "l.speedRank"]


def start_alerts_refreshing(
    flow: DataFrame,
    read_watch,
    out_path: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """J6 K6 D16 with a watch list that changes while the stream runs: every micro-batch of sightings is
    semi-joined with the watch list as ``read_watch()`` returns it at that moment (e.g. a fresh
    ``spark.read`` of the watch-list table). No join state is kept; each batch writes its own folder,
    so a replayed batch replaces its output. ``alerted_at`` is the batch's processing time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(alerts_stream(batch, read_watch()).withColumn("alerted_at", F.current_timestamp()), out_path, batch_id)

    return (
        flow.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ALERT_TRIGGER}))
        .foreachBatch(handle)
        .start()
    )


def start_console(stream: DataFrame, output_mode: str = "update", trigger: dict | None = None):
    """K4 for streams: print each micro-batch (display only)."""
    return (
        stream.writeStream.outputMode(output_mode).format("console").option("truncate", "false")
        .trigger(**(trigger or {"processingTime": SPEED_TRIGGER})).start()
    )
