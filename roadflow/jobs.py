"""End-to-end jobs: read the inputs, compute, write the result table (and snapshot), as the reference's
programs do. Inputs are TSV folders or parquet tables; outputs are parquet tables appended under ``out``.

    python -m roadflow.jobs device-status --flow F --registry R --out O [--run-date D]
    python -m roadflow.jobs top-blocks    --flow F --out O [--n 5]
    python -m roadflow.jobs speed-bands   --flow F --out O
    python -m roadflow.jobs inbound       --flow F --out O [--local-prefix 黑]
    python -m roadflow.jobs track         --flow F --requests Q --out O [--district D --road R]
    python -m roadflow.jobs ingest        --flow-tsv T --out O
    python -m roadflow.jobs live          --kafka-servers S --out O [--topic StreamAuto]
    python -m roadflow.jobs alerts        --kafka-servers S --watch W --out O
    python -m roadflow.jobs track-requests --kafka-servers S --flow F --out O [--topic autotrack --district D --road R]
    python -m roadflow.jobs compact-live  --out O

``--flow`` may be a TSV folder (``--flow-format tsv``) or a stored parquet flow (default). Lines that do not
parse are written below ``out/rejects`` with their reason. Credentials and connection settings are never
defaulted.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from roadflow.operators import device, inbound, ranking, speed, track
from roadflow.session import configure
from roadflow.sinks import tables as sinks
from roadflow.sources import text as tx


def load_flow(spark: SparkSession, path: str, fmt: str = "parquet", rejects: str | None = None) -> DataFrame:
    """The flow; the rejected lines of a TSV folder are written to ``rejects``."""
    configure(spark)
    if fmt != "tsv":
        return tx.read_flow_parquet(spark, path)
    return _accepted(tx.parse_flow_text(spark, path), rejects)


def load_registry(spark: SparkSession, path: str, fmt: str = "tsv", rejects: str | None = None) -> DataFrame:
    """The registry; the rejected lines of a TSV folder are written to ``rejects``."""
    if fmt != "tsv":
        return spark.read.parquet(path)
    return _accepted(tx.parse_registry_text(spark, path), rejects)


def _accepted(parsed: DataFrame, rejects: str | None) -> DataFrame:
    good, bad = tx.split_rejects(parsed)
    if rejects:
        bad.write.mode("overwrite").parquet(rejects)
    return good


def load_plates(spark: SparkSession, path: str) -> DataFrame:
    """A watch-list / request table: JSON lines ``{"plate": ...}`` (as on the request topic)."""
    return tx.parse_request_values(spark.read.text(path))


def device_status_job(spark, flow, registry, out, run_date=None) -> None:
    """``monitor_state`` table, per-day status, chart and web snapshots (job A)."""
    status = device.device_status(flow, registry, run_date).persist()
    sinks.append_table(status, f"{out}/monitor_state", partition_by=["create_date"])
    sinks.append_table(device.device_status_daily(flow, registry), f"{out}/monitor_state_daily", partition_by=["create_date"])
    sinks.append_table(device.offline_cameras_daily(flow, registry), f"{out}/offline_stretches")
    sinks.append_table(device.unregistered_cameras(flow, registry), f"{out}/unregistered_cameras")
    sinks.show(sinks.as_view(status, "monitor_state"))
    sinks.snapshot_json(device.device_chart(status), f"{out}/snapshots/device_chart")
    sinks.snapshot_json(device.device_web(status), f"{out}/snapshots/device_web")
    status.unpersist()


def top_blocks_job(spark, flow, out, n=5, run_date=None) -> None:
    """``TopN_Count`` table (packed), its JSON document and the per-block ranking."""
    packed = ranking.block_vehicle_topn_packed(flow, n, run_date).persist()
    sinks.append_table(packed, f"{out}/TopN_Count")
    sinks.snapshot_json(packed, f"{out}/snapshots/topn_count")
    packed.unpersist()
    sinks.append_table(ranking.block_vehicle_topn(flow, n, run_date), f"{out}/topn_blocks")


def speed_bands_job(spark, flow, out, run_date=None) -> None:
    """``TopN_Speed`` table and speed web snapshot."""
    bands = speed.block_speed_bands(flow, run_date).persist()
    sinks.append_table(bands, f"{out}/TopN_Speed", partition_by=["create_date"])
    sinks.snapshot_json(speed.speed_web(bands), f"{out}/snapshots/speed_web")
    bands.unpersist()


def inbound_job(spark, flow, out, local_prefix=inbound.LOCAL_PREFIX) -> None:
    """``Inbound_Auto`` sightings, first sightings and daily summary."""
    sinks.append_table(inbound.inbound_sightings(flow, local_prefix), f"{out}/Inbound_Auto")
    sinks.append_table(inbound.inbound_first_seen(flow, local_prefix), f"{out}/inbound_first_seen")
    sinks.append_table(inbound.inbound_summary(flow, local_prefix), f"{out}/inbound_summary")


def track_job(spark, flow, requests, out, district=None, road=None, run_date=None) -> None:
    """``Auto_Track`` routes for the requested plates, named when dimensions are given."""
    if district is not None and road is not None:
        routes = track.vehicle_track_named(flow, requests, district, road, run_date)
    else:
        routes = track.vehicle_track(flow, requests, run_date)
    routes = routes.persist()
    sinks.append_table(routes, f"{out}/Auto_Track")
    sinks.write_json_lines(routes, f"{out}/auto_track_json")
    routes.unpersist()


def live_job(parsed: DataFrame, out, trigger=None, show: bool = False, **live_options) -> dict:
    """The live query with its documents, and the rejects, over a parsed flow stream. Totals and provinces count every
    line with a plate."""
    from roadflow.streaming import live, live_job, sources as streams

    queries = {"live": live_job.start_live(streams.with_plate(parsed), out, trigger=trigger, **live_options)}
    queries["rejects"] = streams.start_reject_sink(parsed, f"{out}/rejects/flow", f"{out}/_checkpoints/rejects", trigger)
    if show:
        queries["console"] = live.start_console(live.window_speed_stream(streams.accepted(parsed)), trigger=trigger)
    return queries


def alerts_job(parsed: DataFrame, read_watch, out, trigger=None) -> dict:
    """Alerts and rejects over a parsed flow stream. The watch list is re-read for every micro-batch, so plates
    added while running are picked up."""
    from roadflow.streaming import live, sources as streams

    flow = streams.accepted(parsed)
    return {
        "alerts": live.start_alerts_refreshing(flow, read_watch, f"{out}/alerts", f"{out}/_checkpoints/alerts", trigger),
        "rejects": streams.start_reject_sink(parsed, f"{out}/rejects/flow", f"{out}/_checkpoints/rejects", trigger),
    }


def track_requests_job(spark, requests: DataFrame, out, read_flow, district=None, road=None, run_date=None, trigger=None) -> dict:
    """Routes for streamed requests over the log as it is at each request, as a table and as JSON documents, with
    names when the dimension tables' paths are given."""
    from roadflow.streaming import live

    names = (lambda: (spark.read.parquet(district), spark.read.parquet(road))) if district and road else None
    q = live.start_track_requests(read_flow, requests, f"{out}/Auto_Track", f"{out}/_checkpoints/track", run_date, trigger, names, f"{out}/auto_track_json")
    return {"track": q}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="roadflow.jobs")
    p.add_argument("job", choices=["device-status", "top-blocks", "speed-bands", "inbound", "track", "ingest", "live", "alerts", "track-requests", "compact-live"])
    p.add_argument("--flow")
    p.add_argument("--flow-format", default="parquet", choices=["parquet", "tsv"])
    p.add_argument("--flow-tsv")
    p.add_argument("--registry")
    p.add_argument("--registry-format", default="tsv", choices=["parquet", "tsv"])
    p.add_argument("--requests")
    p.add_argument("--watch")
    p.add_argument("--district")
    p.add_argument("--road")
    p.add_argument("--out", required=True)
    p.add_argument("--run-date")
    p.add_argument("--n", type=int, default=5)
    p.add_argument("--local-prefix", default=inbound.LOCAL_PREFIX)
    p.add_argument("--kafka-servers")
    p.add_argument("--topic", help="flow topic (default StreamAuto), or the request topic of track-requests (default autotrack)")
    p.add_argument("--show", action="store_true", help="live: also print each batch of window speeds")
    p.add_argument("--input-bytes", type=int, help="input volume; sizes shuffle width and scan splits")
    a = p.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"roadflow-{a.job}").getOrCreate())
    if a.input_bytes:
        from roadflow.session import apply_scale_conf

        apply_scale_conf(spark, a.input_bytes)
    if a.job == "ingest":
        tx.ingest_flow_tsv(spark, a.flow_tsv, f"{a.out}/flow", f"{a.out}/flow_rejects")
        return
    if a.job == "compact-live":
        from roadflow.streaming import live_job as one

        one.compact_closed(spark, a.out, remove=True)
        return
    if a.job in ("live", "alerts", "track-requests"):
        from roadflow.streaming import live, sources as streams

        if a.job == "track-requests":
            asked = streams.kafka_requests(spark, a.kafka_servers, a.topic or "autotrack")
            queries = track_requests_job(spark, asked, a.out, lambda: load_flow(spark, a.flow, a.flow_format), a.district, a.road, a.run_date)
        else:
            parsed = streams.kafka_flow_parsed(spark, a.kafka_servers, a.topic or "StreamAuto")
            if a.job == "live":
                queries = live_job(parsed, a.out, show=a.show)
            else:
                queries = alerts_job(parsed, lambda: load_plates(spark, a.watch), a.out)
        # return (or raise) as soon as any of the queries stops, so a failed one is never waited past
        spark.streams.awaitAnyTermination()
        for q in queries.values():
            q.stop()
        return
    flow = load_flow(spark, a.flow, a.flow_format, f"{a.out}/rejects/flow")
    if a.job == "device-status":
        registry = load_registry(spark, a.registry, a.registry_format, f"{a.out}/rejects/registry")
        device_status_job(spark, flow, registry, a.out, a.run_date)
    elif a.job == "top-blocks":
        top_blocks_job(spark, flow, a.out, a.n, a.run_date)
    elif a.job == "speed-bands":
        speed_bands_job(spark, flow, a.out, a.run_date)
    elif a.job == "inbound":
        inbound_job(spark, flow, a.out, a.local_prefix)
    elif a.job == "track":
        dims = (spark.read.parquet(a.district), spark.read.parquet(a.road)) if a.district and a.road else (None, None)
        track_job(spark, flow, load_plates(spark, a.requests), a.out, *dims, run_date=a.run_date)


if __name__ == "__main__":
    main()
