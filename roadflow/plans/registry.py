"""Query registry: name -> callable(spark, sf_dir) -> DataFrame, over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadflow.operators import device, inbound, ranking, speed, track
from roadflow.plans.params import RUN_DATE, TOP_N
from roadflow.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("device_status")
def q_device_status(spark, sf):
    return device.device_status(fx.flow(spark, sf), fx.registry(spark, sf), RUN_DATE)


@register("device_status_daily")
def q_device_status_daily(spark, sf):
    return device.device_status_daily(fx.flow(spark, sf), fx.registry(spark, sf))


@register("offline_cameras")
def q_offline_cameras(spark, sf):
    return device.offline_cameras(fx.flow(spark, sf), fx.registry(spark, sf))


@register("offline_cameras_daily")
def q_offline_cameras_daily(spark, sf):
    return device.offline_cameras_daily(fx.flow(spark, sf), fx.registry(spark, sf))


@register("unregistered_cameras")
def q_unregistered(spark, sf):
    return device.unregistered_cameras(fx.flow(spark, sf), fx.registry(spark, sf))


@register("block_vehicle_counts")
def q_block_vehicle_counts(spark, sf):
    return ranking.block_vehicle_counts(fx.flow(spark, sf))


@register("block_vehicle_topn")
def q_block_vehicle_topn(spark, sf):
    return ranking.block_vehicle_topn(fx.flow(spark, sf), TOP_N, RUN_DATE)


@register("block_vehicle_topn_packed")
def q_block_vehicle_topn_packed(spark, sf):
    return ranking.block_vehicle_topn_packed(fx.flow(spark, sf), TOP_N, RUN_DATE)


@register("block_speed_bands")
def q_block_speed_bands(spark, sf):
    return speed.block_speed_bands(fx.flow(spark, sf), RUN_DATE)


@register("block_speed_web")
def q_block_speed_web(spark, sf):
    return speed.speed_web(speed.block_speed_bands(fx.flow(spark, sf), RUN_DATE))


@register("inbound_sightings")
def q_inbound_sightings(spark, sf):
    return inbound.inbound_sightings(fx.flow(spark, sf))


@register("inbound_first_seen")
def q_inbound_first_seen(spark, sf):
    return inbound.inbound_first_seen(fx.flow(spark, sf))


@register("inbound_summary")
def q_inbound_summary(spark, sf):
    return inbound.inbound_summary(fx.flow(spark, sf))


@register("vehicle_track")
def q_vehicle_track(spark, sf):
    return track.vehicle_track(fx.flow(spark, sf), fx.requests(spark, sf), RUN_DATE)


@register("vehicle_track_named")
def q_vehicle_track_named(spark, sf):
    return track.vehicle_track_named(
        fx.flow(spark, sf), fx.requests(spark, sf), fx.district(spark, sf), fx.road(spark, sf), RUN_DATE
    )


@register("vehicle_track_steps")
def q_vehicle_track_steps(spark, sf):
    return track.vehicle_track_steps(fx.flow(spark, sf), fx.requests(spark, sf))


# --- provinces, time and text jobs -----------------------------------------------------------------

from roadflow.operators import province, textops, timeops  # noqa: E402
from roadflow.plans.params import RANGE_HI, RANGE_LO, SLICE_RUN_DATE  # noqa: E402


@register("province_counts")
def q_province_counts(spark, sf):
    return province.province_counts(spark, fx.flow(spark, sf))


@register("province_snapshot")
def q_province_snapshot(spark, sf):
    return province.province_snapshot(province.province_counts(spark, fx.flow(spark, sf)))


@register("flow_by_hour")
def q_flow_by_hour(spark, sf):
    return timeops.flow_by_hour(fx.flow(spark, sf))


@register("flow_by_5min")
def q_flow_by_5min(spark, sf):
    return timeops.flow_by_5min(fx.flow(spark, sf))


@register("sighting_gap")
def q_sighting_gap(spark, sf):
    return timeops.sighting_gap(fx.flow(spark, sf))


@register("flow_between")
def q_flow_between(spark, sf):
    return timeops.flow_between(fx.flow(spark, sf), RANGE_LO, RANGE_HI)


@register("date_keys")
def q_date_keys(spark, sf):
    return timeops.date_keys(fx.flow(spark, sf))


@register("flow_day_slice")
def q_flow_day_slice(spark, sf):
    return timeops.flow_day_slice(fx.flow(spark, sf), SLICE_RUN_DATE)


@register("typed_ingest")
def q_typed_ingest(spark, sf):
    return textops.typed_ingest_counts(fx.flow(spark, sf))


@register("fixed_width_ids")
def q_fixed_width_ids(spark, sf):
    return textops.fixed_width_ids(fx.flow(spark, sf))


@register("kv_expand")
def q_kv_expand(spark, sf):
    return textops.kv_expand(fx.flow(spark, sf))


@register("kv_update")
def q_kv_update(spark, sf):
    return textops.kv_update(fx.flow(spark, sf))


@register("comma_clean")
def q_comma_clean(spark, sf):
    return textops.comma_clean(fx.flow(spark, sf))


# --- streaming jobs, driven to completion over the events table ---------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from roadflow.plans.params import STREAM_LOCAL_PREFIX, WINDOW_SIZE_H, WINDOW_SLIDE_H  # noqa: E402
from roadflow.session import scratch_path  # noqa: E402
from roadflow.streaming import live, live_job  # noqa: E402
from roadflow.streaming import sources as streams  # noqa: E402

SIZE, SLIDE = f"{WINDOW_SIZE_H} hours", f"{WINDOW_SLIDE_H} hours"


def _in_parts(spark, sf, in_order: bool, start, inbox: str | None = None) -> None:
    """The whole events table arrives in four parts; ``start(stream)`` is run again for each part, so that every
    query goes on from its checkpoint over several batches. ``in_order``: parts are consecutive stretches of
    time, else each part spans all of it."""
    events = fx.table(spark, sf, "events")
    if in_order:
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        cuts = events.agg(F.percentile_approx(at, [0.25, 0.5, 0.75], 1000)).first()[0] or [0, 0, 0]
        part = sum((F.when(at > c, 1).otherwise(0) for c in cuts), F.lit(0))
    else:
        part = F.pmod("event_id", F.lit(4))
    inbox = inbox or scratch_path(spark, "events-inbox")
    for k in range(4):
        events.where(part == k).write.mode("append").parquet(inbox)
        for q in start(streams.events_folder_stream(spark, inbox, events.schema)):
            q.awaitTermination()


@register("stream_window_speed")
def q_stream_window_speed(spark, sf):
    """Windows on arrival time over several batches, restarted from the checkpoint."""
    out, ck = scratch_path(spark, "window-speed-out"), scratch_path(spark, "window-speed-ckpt")

    def start(flow):
        return [live.start_to_table(live.window_speed_stream(flow, SIZE, SLIDE), out, ck, "update", {"availableNow": True})]

    _in_parts(spark, sf, True, start)
    return live.latest_rows(spark, out, live.SPEED_KEYS)


@register("stream_event_window")
def q_stream_event_window(spark, sf):
    """G9 on event time with sightings out of order over several batches: none is lost."""
    out, ck = scratch_path(spark, "event-window-out"), scratch_path(spark, "event-window-ckpt")
    _in_parts(spark, sf, False, lambda flow: [live.start_event_windows(flow, out, ck, SIZE, SLIDE, {"availableNow": True})])
    return live.read_event_windows(spark, out)


@register("stream_totals")
def q_stream_totals(spark, sf):
    s = live.totals_stream(streams.events_flow_stream(spark, sf), STREAM_LOCAL_PREFIX)
    return live.run_available_now(spark, s, "stream_totals", [], output_mode="complete")


@register("stream_provinces")
def q_stream_provinces(spark, sf):
    s = live.province_prefix_stream(streams.events_flow_stream(spark, sf))
    counts = live.run_available_now(spark, s, "stream_provinces", ["prefix"], output_mode="update")
    return province.fold_provinces(spark, counts)


@register("stream_alerts")
def q_stream_alerts(spark, sf):
    s = live.alerts_stream(streams.events_flow_stream(spark, sf), fx.requests(spark, sf))
    return live.run_available_now(spark, s, "stream_alerts", None)


def _track_requests(spark, sf, read_dimensions=None, json_path=None, for_requests=None):
    # Request messages as the request topic would carry them, written by Spark from the customer table.
    inbox = scratch_path(spark, "track-requests-inbox")
    fx.requests(spark, sf).select(F.to_json(F.struct("plate")).alias("value")).write.text(inbox)
    out = scratch_path(spark, "track-requests-out")
    q = live.start_track_requests(
        lambda: fx.flow(spark, sf),
        streams.text_request_stream(spark, inbox),
        out,
        scratch_path(spark, "track-requests-ckpt"),
        RUN_DATE,
        {"availableNow": True},
        read_dimensions,
        json_path,
        for_requests,
    )
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@register("stream_track_requests")
def q_stream_track_requests(spark, sf):
    return _track_requests(spark, sf)


@register("stream_track_json")
def q_stream_track_json(spark, sf):
    """The routes with names, read back from their JSON documents."""
    path = scratch_path(spark, "track-json")
    routes = _track_requests(spark, sf, lambda: (fx.district(spark, sf), fx.road(spark, sf)), path)
    return spark.read.schema(routes.schema).json(f"{path}/batch_id=*")


# --- sinks: written, then read back -----------------------------------------------------------------

from roadflow.sinks import tables as sinks  # noqa: E402


@register("device_chart_snapshot")
def q_device_chart_snapshot(spark, sf):
    chart = device.device_chart(device.device_status(fx.flow(spark, sf), fx.registry(spark, sf), RUN_DATE))
    path = scratch_path(spark, "device-chart-snapshot")
    sinks.snapshot_json(chart, path)
    return sinks.read_snapshot(spark, path, chart.schema)


@register("device_web_snapshot")
def q_device_web_snapshot(spark, sf):
    web = device.device_web(device.device_status(fx.flow(spark, sf), fx.registry(spark, sf), RUN_DATE))
    path = scratch_path(spark, "device-web-snapshot")
    sinks.snapshot_json(web, path)
    return sinks.read_snapshot(spark, path, web.schema)


@register("table_append")
def q_table_append(spark, sf):
    bands = speed.block_speed_bands(fx.flow(spark, sf), RUN_DATE)
    path = scratch_path(spark, "topn-speed-table")
    sinks.append_table(bands, path, partition_by=["create_date"])
    sinks.append_table(bands, path, partition_by=["create_date"])
    return spark.read.parquet(path).select(*bands.columns)


@register("topn_snapshot")
def q_topn_snapshot(spark, sf):
    """K2: the top-N document written as JSON and read back."""
    packed = ranking.block_vehicle_topn_packed(fx.flow(spark, sf), TOP_N, RUN_DATE)
    path = scratch_path(spark, "topn-snapshot")
    sinks.snapshot_json(packed, path)
    return sinks.read_snapshot(spark, path, packed.schema)


@register("speed_bands_view")
def q_speed_bands_view(spark, sf):
    """A result registered as a view and read by ``select *``."""
    sinks.as_view(speed.block_speed_bands(fx.flow(spark, sf), RUN_DATE), "top_speed")
    return spark.sql("select * from top_speed")


@register("registry_tsv")
def q_registry_tsv(spark, sf):
    """The registry as tab-separated text, with a line that lacks its camera for every block, read back:
    cameras, and rejected lines per reason."""
    from roadflow.sources import text as tx

    path = scratch_path(spark, "registry-tsv")
    cameras = fx.registry(spark, sf)
    lines = cameras.select(F.concat_ws("\t", "block_id", F.concat(F.lit(" "), "monitor_id", F.lit(" "))).alias("value"))
    lines.unionByName(cameras.select(F.col("block_id").alias("value")).distinct()).write.text(path)
    good, bad = tx.split_rejects(tx.parse_registry_text(spark, path))
    return good.select(F.col("block_id").alias("blockid"), "monitor_id", F.lit("accepted").alias("status")).unionByName(
        bad.select(F.col("value").alias("blockid"), F.lit(None).cast("string").alias("monitor_id"), F.col("reject_reason").alias("status"))
    )


@register("stream_speed_rank")
def q_stream_speed_rank(spark, sf):
    s = live.window_speed_stream(streams.events_flow_stream(spark, sf), SIZE, SLIDE)
    speeds = live.run_available_now(spark, s, "stream_speed_rank", live.SPEED_KEYS)
    return live.speed_rank(speeds).select("window_start", "window_end", "blockRank", "speedRank")


def _live(spark, sf) -> str:
    """The live job (T5) over several batches, restarted from its checkpoint."""
    out = scratch_path(spark, "live")
    _in_parts(
        spark, sf, True,
        lambda flow: [live_job.start_live(flow, out, SIZE, SLIDE, "1 day", STREAM_LOCAL_PREFIX, {"availableNow": True}, run_date=RUN_DATE)],
    )
    return out


@register("stream_live_snapshot")
def q_stream_live_snapshot(spark, sf):
    snap = live_job.read_live(spark, _live(spark, sf), SIZE, SLIDE, RUN_DATE)["snapshot"]
    path = scratch_path(spark, "live-snapshot")
    sinks.snapshot_json(snap, path)
    return sinks.read_snapshot(spark, path, snap.schema)


@register("stream_live_web")
def q_stream_live_web(spark, sf):
    """K3: the web document of the newest batch."""
    schema = "create_date date, currentAutoCount bigint, currentInboundAuto bigint, speedRank string"
    return live_job.read_document(spark, _live(spark, sf), "live_web", schema)


@register("stream_live_chart")
def q_stream_live_chart(spark, sf):
    """K3: the chart document of the newest batch."""
    schema = "create_date date, currenAutoCount bigint, currentInboundAuto bigint, blockRank string, speedRank string"
    return live_job.read_document(spark, _live(spark, sf), "live_chart", schema)


@register("stream_province_snapshot")
def q_stream_province_snapshot(spark, sf):
    """K3: the province document of the newest batch."""
    return live_job.read_document(spark, _live(spark, sf), "province", "provinceList string, provinceCount string")


@register("stream_live_windows")
def q_stream_live_windows(spark, sf):
    """All window means of the live job, put together from closed and open panes."""
    return live_job.read_live(spark, _live(spark, sf), SIZE, SLIDE)["window_speed"]


@register("tsv_ingest")
def q_tsv_ingest(spark, sf):
    """The flow written as the reference's TSV text in two parts (even and odd years), each ingested into one
    store, the second part twice, then packed; read back: accepted rows per day and rejected rows per reason."""
    from roadflow.sources import store

    at = scratch_path(spark, "flow-store")
    flow = fx.flow(spark, sf)
    for k in (0, 1):
        lines = scratch_path(spark, "flow-tsv")
        textops.flow_lines(flow.where(F.year("create_date") % 2 == k)).write.text(lines)
        for _ in range(1 + k):
            store.ingest(spark, lines, at)
    store.pack(spark, at)
    accepted = store.read_flow(spark, at).groupBy(F.lit("accepted").alias("status"), "create_date").agg(F.count(F.lit(1)).alias("rows"))
    rejected = store.read_rejects(spark, at).groupBy(
        F.col("reject_reason").alias("status"), F.lit(None).cast("date").alias("create_date")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return accepted.unionByName(rejected)


@register("table_append_once")
def q_table_append_once(spark, sf):
    """K1 exactly once: two runs, the first started twice."""
    bands = speed.block_speed_bands(fx.flow(spark, sf), RUN_DATE)
    path = scratch_path(spark, "append-once")
    for run in ("a", "a", "b"):
        sinks.append_once(bands, path, run, ["create_date"])
    return sinks.read_appended(spark, path).select("run_id", *bands.columns)


# --- stored sketches, plate-clustered store, Bloom prefilter -----------------------------------------

from roadflow.operators import track_store  # noqa: E402
from roadflow.streaming import joins  # noqa: E402


def _sketched(spark, sf):
    """Exact and estimated distinct vehicles per block in a year of days, the estimate from stored sketches."""
    flow, path = fx.flow(spark, sf), scratch_path(spark, "daily-sketches")
    ranking.daily_sketches(flow).write.parquet(path)
    days = F.col("create_date").between(RANGE_LO[:10], RANGE_HI[:10])
    estimated = ranking.merged_vehicle_counts(spark.read.parquet(path).where(days)).withColumnRenamed("autocount", "estimate")
    exact = flow.where(days).groupBy(F.col("block_id").alias("blockid")).agg(F.count_distinct("plate").alias("autocount"))
    return exact.join(estimated, "blockid")


@register("block_vehicle_sketch")
def q_block_vehicle_sketch(spark, sf):
    """The estimate from merged sketches with its measured error beside the exact count."""
    error = F.abs(F.col("estimate") - F.col("autocount")) / F.col("autocount")
    return _sketched(spark, sf).select("blockid", "autocount", "estimate", error.alias("error"))


@register("block_vehicle_sketch_bound")
def q_block_vehicle_sketch_bound(spark, sf):
    """The exact count, the sightings kept with the sketches, and whether the estimate is within 5 %."""
    near = F.abs(F.col("estimate") - F.col("autocount")) <= 0.05 * F.col("autocount")
    return _sketched(spark, sf).select("blockid", "autocount", "sightings", near.alias("within_bound"))


def _plate_store(spark, sf):
    path = scratch_path(spark, "plate-store")
    table = f"plate_store_{path[-12:]}"
    track_store.write_plate_store(fx.flow(spark, sf), table, path, 16)
    return table


@register("vehicle_track_store")
def q_vehicle_track_store(spark, sf):
    """The routes from the plate-clustered store, the requests joined."""
    asked = fx.requests(spark, sf)
    return track.vehicle_track(track_store.stored_sightings(spark.table(_plate_store(spark, sf)), asked, most=0), asked, RUN_DATE)


@register("stream_track_store")
def q_stream_track_store(spark, sf):
    """Requests on a stream, answered from the buckets of their plates."""
    table = _plate_store(spark, sf)
    return _track_requests(spark, sf, for_requests=lambda asked: track_store.stored_sightings(spark.table(table), asked))


@register("listed_sightings")
def q_listed_sightings(spark, sf):
    """Sightings of a listed plate, filtered by the list's Bloom filter before the shuffled join."""
    rows = track_store.listed_sightings(fx.flow(spark, sf), fx.requests(spark, sf), 100_000)
    return rows.select("plate", F.col("block_id").alias("blockid"), F.col("action_time").alias("time"), "speed")


# --- streams joined with streams, keyed state, state read back --------------------------------------


@register("stream_watch_join")
def q_stream_watch_join(spark, sf):
    """Plates asked for on one stream, sightings on another, over several batches and restarts."""
    out, ck, inbox = (scratch_path(spark, f"watch-join-{n}") for n in ("out", "ckpt", "inbox"))
    schema = fx.table(spark, sf, "events").schema

    def start(flow):
        asked = streams.events_folder_stream(spark, inbox, schema).where(F.col("event_id") % 50 == 7)
        watch = asked.select("plate", F.col("action_time").alias("asked_at"))
        return [live.start_append(joins.watched_sightings(flow, watch, "12 hours", "1 hour"), out, ck, {"availableNow": True})]

    _in_parts(spark, sf, True, start, inbox)
    return spark.read.parquet(out)


@register("stream_first_seen")
def q_stream_first_seen(spark, sf):
    """Each inbound vehicle once, over several batches and restarts."""
    out, ck = scratch_path(spark, "first-seen-out"), scratch_path(spark, "first-seen-ckpt")
    _in_parts(spark, sf, True, lambda flow: [live.start_append(joins.first_sightings(flow, "3650 days"), out, ck, {"availableNow": True})])
    return spark.read.schema(joins.FIRST).parquet(out)


def _state_of(spark, sf, stream_of, mode):
    out, ck = scratch_path(spark, "state-out"), scratch_path(spark, "state-ckpt")
    _in_parts(spark, sf, True, lambda flow: [live.start_to_table(stream_of(flow), out, ck, mode, {"availableNow": True})])
    return ck


@register("stream_totals_state")
def q_stream_totals_state(spark, sf):
    """The running totals read from the state of the query, not from its batches."""
    return joins.running_totals(spark, _state_of(spark, sf, lambda flow: live.totals_stream(flow, STREAM_LOCAL_PREFIX), "complete"))


@register("stream_provinces_state")
def q_stream_provinces_state(spark, sf):
    """The running province counts read from the state of the query."""
    return province.fold_provinces(spark, joins.running_prefixes(spark, _state_of(spark, sf, live.province_prefix_stream, "update")))
