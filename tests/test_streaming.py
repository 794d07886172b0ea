"""Streaming = batch on the same rows (SURVEY §5 (3)), on files written by the test."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from roadflow.operators import province
from roadflow.streaming import live
from roadflow.streaming import sources as streams


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_window_totals_provinces_alerts(spark):
    """Window means over the speed field (D10); alerts carry real fields and HH:mm time."""
    d = tempfile.mkdtemp(prefix="roadflow-stream-")
    lines = []
    for i in range(40):
        plate = ["黑A00001", "京B00002", "粤C00003", "黑B00004"][i % 4]
        t = f"2018-04-26 10:{i // 4:02d}:{(i * 7) % 60:02d}"
        lines.append(f"2018-04-26\t000{i % 3}\t{i:05d}\t{plate}\t{t}\t{i * 3}\t{i % 5 + 1}\t0{i % 8}")
    lines.append("broken line")
    _write_lines(os.path.join(d, "flow"), "part-0.tsv", lines)

    flow_s = streams.text_flow_stream(spark, os.path.join(d, "flow"))
    batch = streams.split_rejects(streams.parse_flow_lines(spark.read.text(os.path.join(d, "flow"))))[0]

    w = live.run_available_now(spark, live.window_speed_stream(flow_s, "2 minutes", "1 minute", time="action_time"), "t_win", ["window_start", "window_end", "blockid"])
    ev = batch.withColumn("event_ts", F.col("action_time").cast("timestamp"))
    b = ev.groupBy(F.window("event_ts", "2 minutes", "1 minute").alias("w"), F.col("block_id").alias("blockid")).agg(
        F.expr("sum(speed) div count(speed)").alias("avg_speed"), F.count(F.lit(1)).alias("sightings"))
    b = b.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "blockid", "avg_speed", "sightings")
    assert sorted(map(tuple, w.collect())) == sorted(map(tuple, b.collect()))

    tot = live.run_available_now(spark, live.totals_stream(streams.text_flow_stream(spark, os.path.join(d, "flow"))), "t_tot", [], "complete").collect()[0]
    assert (tot.current_auto_count, tot.current_inbound_auto) == (40, 30)

    counts = live.run_available_now(spark, live.province_prefix_stream(streams.text_flow_stream(spark, os.path.join(d, "flow"))), "t_prov", ["prefix"])
    got = {r.province: r.sightings for r in province.fold_provinces(spark, counts).collect()}
    assert got["黑龙江"] == 20 and got["北京"] == 10 and got["other"] == 10 and got["上海"] == 0

    watch = spark.createDataFrame([("京B00002",)], "plate string")
    alerts = live.run_available_now(spark, live.alerts_stream(streams.text_flow_stream(spark, os.path.join(d, "flow")), watch), "t_alert", None).collect()
    assert len(alerts) == 10 and {a.plate for a in alerts} == {"京B00002"}
    assert all(len(a.alert_time) == 5 for a in alerts)


def test_request_driven_track(spark):
    from conftest import flow_rows

    d = tempfile.mkdtemp(prefix="roadflow-req-")
    _write_lines(os.path.join(d, "req"), "r.json", [json.dumps({"plate": "京A1"}, ensure_ascii=False), json.dumps({"plate": ""})])
    flow = flow_rows(spark, [("2018-04-26", "0002", "1", "京A1", "2018-04-26 02:00:00", 1, "5", "01"),
                             ("2018-04-26", "0001", "1", "京A1", "2018-04-26 01:00:00", 1, "4", "01")])
    out = os.path.join(d, "out")
    q = live.start_track_requests(lambda: flow, streams.text_request_stream(spark, os.path.join(d, "req")), out, os.path.join(d, "ck"), "2018-04-27", {"availableNow": True})
    q.awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert [(r.plate, r.blockid, r.roadid) for r in rows] == [("京A1", "0001>0002", "4>5")]


def test_multi_batch_update_mode_equals_batch(spark):
    """Three files in time order, one per trigger: windows updated across batches; the latest row per
    window equals the batch aggregate (nothing is late: each file is newer than the watermark)."""
    d = tempfile.mkdtemp(prefix="roadflow-mb-")
    for f in range(3):
        lines = []
        for i in range(30):
            t = f"2018-04-26 1{f}:{(i * 2) % 60:02d}:{i % 60:02d}"
            lines.append(f"2018-04-26\t000{i % 2}\t{i:05d}\t京A{i % 5:05d}\t{t}\t{(i * 11 + f) % 140}\t1\t01")
        _write_lines(os.path.join(d, "flow"), f"part-{f}.tsv", lines)
    stream = live.window_speed_stream(streams.text_flow_stream(spark, os.path.join(d, "flow"), max_files_per_trigger=1), "30 minutes", "15 minutes", "10 minutes", "action_time")
    out = live.run_available_now(spark, stream, "t_mb", ["window_start", "window_end", "blockid"])
    batch = streams.split_rejects(streams.parse_flow_lines(spark.read.text(os.path.join(d, "flow"))))[0]
    ev = batch.withColumn("event_ts", F.col("action_time").cast("timestamp"))
    want = ev.groupBy(F.window("event_ts", "30 minutes", "15 minutes").alias("w"), F.col("block_id").alias("blockid")).agg(
        F.expr("sum(speed) div count(speed)").alias("avg_speed"), F.count(F.lit(1)).alias("sightings"))
    want = want.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "blockid", "avg_speed", "sightings")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))

    # the same run, folded into one table of latest rows
    ck, res = os.path.join(d, "ck2"), os.path.join(d, "res2")
    s2 = live.window_speed_stream(streams.text_flow_stream(spark, os.path.join(d, "flow"), max_files_per_trigger=1), "30 minutes", "15 minutes", "10 minutes", "action_time")
    live.start_to_table(s2, res, ck, "update", {"availableNow": True}).awaitTermination()
    keys = ["window_start", "window_end", "blockid"]
    assert live.compact(spark, res, keys) >= 3 and live.compact(spark, res, keys) == 0
    folded = live.latest_rows(spark, res, keys).select(*want.columns)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, want.collect()))


def test_replayed_batch_overwrites_its_own_output(spark):
    d = tempfile.mkdtemp(prefix="roadflow-idem-")
    df, out = spark.range(5), os.path.join(d, "out")
    live._write_batch(df, out, 0)
    live._write_batch(df, out, 0)  # a retried micro-batch
    live._write_batch(spark.range(2), out, 1)
    assert spark.read.parquet(os.path.join(d, "out")).count() == 7


def test_alerts_pick_up_watch_list_changes(spark):
    """A plate added to the watch-list table between two runs is alerted on in the second run."""
    d = tempfile.mkdtemp(prefix="roadflow-watch-")
    line = "2018-04-26\t0001\t00001\t{p}\t2018-04-26 10:00:0{i}\t50\t1\t01"
    _write_lines(os.path.join(d, "flow"), "a.tsv", [line.format(p="京A1", i=1), line.format(p="京B2", i=2)])
    _write_lines(os.path.join(d, "watch"), "w1.json", [json.dumps({"plate": "京A1"}, ensure_ascii=False)])

    def read_watch():
        return streams.parse_request_values(spark.read.text(os.path.join(d, "watch")))

    def run():
        q = live.start_alerts_refreshing(
            streams.text_flow_stream(spark, os.path.join(d, "flow")), read_watch, os.path.join(d, "out"),
            os.path.join(d, "ck"), {"availableNow": True})
        q.awaitTermination()

    run()
    _write_lines(os.path.join(d, "watch"), "w2.json", [json.dumps({"plate": "京B2"}, ensure_ascii=False)])
    _write_lines(os.path.join(d, "flow"), "b.tsv", [line.format(p="京B2", i=3)])
    run()
    got = sorted((r.plate, str(r.time)) for r in spark.read.parquet(os.path.join(d, "out")).collect())
    assert got == [("京A1", "2018-04-26 10:00:01"), ("京B2", "2018-04-26 10:00:03")]


def test_late_rows_beyond_watermark_are_dropped(spark):
    """Rows are judged late against the previous batch's watermark (Spark >= 3.4). After batches at
    12:0x and 12:30 the watermark is 11:51 (10-minute delay); a 10:00 row arriving in the third batch is
    dropped, the 12:40 row beside it is counted."""
    d = tempfile.mkdtemp(prefix="roadflow-late-")
    row = "2018-04-26\t0001\t00001\t京A1\t2018-04-26 {t}\t{s}\t1\t01"
    files = [("a.tsv", [("12:00:00", 10), ("12:01:00", 20)]), ("b.tsv", [("12:30:00", 30)]),
             ("c.tsv", [("10:00:00", 99), ("12:40:00", 40)])]
    for i, (name, rows) in enumerate(files):
        _write_lines(os.path.join(d, "flow"), name, [row.format(t=t, s=v) for t, v in rows])
        os.utime(os.path.join(d, "flow", name), (1_600_000_000 + i * 10, 1_600_000_000 + i * 10))  # file order
    stream = live.window_speed_stream(
        streams.text_flow_stream(spark, os.path.join(d, "flow"), max_files_per_trigger=1), "1 hour", "1 hour", "10 minutes", "action_time")
    out = live.run_available_now(spark, stream, "t_late", ["window_start", "window_end", "blockid"])
    got = {str(r.window_start): (r.avg_speed, r.sightings) for r in out.collect()}
    assert got == {"2018-04-26 12:00:00": (25, 4)}  # (10 + 20 + 30 + 40) div 4; the 10:00 row is gone


def test_stream_rejects_are_kept(spark):
    d = tempfile.mkdtemp(prefix="roadflow-rej-")
    _write_lines(os.path.join(d, "in"), "a.tsv", [
        "2018-04-26\t0001\t00001\t京A1\t2018-04-26 10:00:00\t50\t1\t01",
        "2018-04-26\t0001\t00001\t京A1\tnot-a-time\t50\t1\t01",
        "short\tline",
    ])
    q = streams.start_reject_sink(streams.text_flow_parsed(spark, os.path.join(d, "in")), os.path.join(d, "rej"),
                                  os.path.join(d, "ck"), {"availableNow": True})
    q.awaitTermination()
    got = sorted(r.reject_reason for r in spark.read.parquet(os.path.join(d, "rej")).collect())
    assert got == ["bad_time", "short_line"]


def _late_files(d):
    row = "2018-04-26\t0001\t00001\t京A1\t2018-04-26 {t}\t{s}\t1\t01"
    for i, rows in enumerate([[("12:00:00", 10), ("12:01:00", 20)], [("12:30:00", 30)], [("10:00:00", 99), ("12:40:00", 40)]]):
        _write_lines(os.path.join(d, "flow"), f"{i}.tsv", [row.format(t=t, s=v) for t, v in rows])
        os.utime(os.path.join(d, "flow", f"{i}.tsv"), (1_600_000_000 + i * 10, 1_600_000_000 + i * 10))


def test_event_windows_keep_late_rows(spark):
    """The rows of the watermark test above, as event-time partials: the late 10:00 row is in its window, before
    and after compaction, and after more batches on top of a compacted table."""
    d = tempfile.mkdtemp(prefix="roadflow-ev-")
    _late_files(d)
    out, ck = os.path.join(d, "out"), os.path.join(d, "ck")

    def run():
        flow = streams.text_flow_stream(spark, os.path.join(d, "flow"), max_files_per_trigger=1)
        live.start_event_windows(flow, out, ck, "1 hour", "1 hour", {"availableNow": True}).awaitTermination()

    def got():
        return {str(r.window_start)[11:16]: (r.avg_speed, r.sightings) for r in live.read_event_windows(spark, out).collect()}

    run()
    assert got() == {"12:00": (25, 4), "10:00": (99, 1)}
    assert live.compact(spark, out, None, remove=True) == 3
    assert got() == {"12:00": (25, 4), "10:00": (99, 1)} and not [n for n in os.listdir(out) if n.startswith("batch_id")]
    _write_lines(os.path.join(d, "flow"), "3.tsv", ["2018-04-26\t0001\t1\t京A1\t2018-04-26 10:30:00\t1\t1\t01"])
    run()
    assert got() == {"12:00": (25, 4), "10:00": (50, 2)}
    assert live.compact(spark, out, None) == 1 and got() == {"12:00": (25, 4), "10:00": (50, 2)}


def test_arrival_windows_lose_nothing(spark):
    """By default windows run on arrival: the same late row counts where it arrived."""
    d = tempfile.mkdtemp(prefix="roadflow-arr-")
    _late_files(d)
    stream = live.window_speed_stream(streams.text_flow_stream(spark, os.path.join(d, "flow"), max_files_per_trigger=1), "1 hour", "1 hour", "1 second")
    out = live.run_available_now(spark, stream, "t_arr", live.SPEED_KEYS).collect()
    assert [(r.avg_speed, r.sightings) for r in out] == [(39, 5)]


def test_null_speeds_are_not_in_the_divisor(spark):
    rows = spark.sql("select '0001' as block_id, timestamp_ntz'2018-04-26 10:00:00' as action_time, explode(array(10, null, 20)) as speed")
    got = live.window_partials(rows, "1 hour", "1 hour").collect()[0]
    assert (got.speed_sum, got.speed_count, got.sightings) == (30, 2, 3)


def test_requests_see_sightings_stored_between_them(spark):
    from conftest import flow_rows

    d = tempfile.mkdtemp(prefix="roadflow-req2-")
    seen = lambda p, h: flow_rows(spark, [("2018-04-26", f"000{h}", "1", p, f"2018-04-26 0{h}:00:00", 1, "5", "01")])
    store, out = os.path.join(d, "flow"), os.path.join(d, "out")
    dims = lambda: (spark.createDataFrame([(1, "One")], "district_id int, district_name string"),
                    spark.createDataFrame([(5, "Five")], "road_id int, road_name string"))

    def ask(name, plate):
        _write_lines(os.path.join(d, "req"), name, [json.dumps({"plate": plate}, ensure_ascii=False)])
        live.start_track_requests(lambda: spark.read.parquet(store), streams.text_request_stream(spark, os.path.join(d, "req")), out,
                                  os.path.join(d, "ck"), "2018-04-27", {"availableNow": True}, dims, os.path.join(d, "json")).awaitTermination()

    seen("京A1", 1).write.mode("append").parquet(store)
    ask("1.json", "京A1")
    seen("京A1", 2).unionByName(seen("京B2", 3)).write.mode("append").parquet(store)
    ask("2.json", "京A1")
    ask("3.json", "京B2")
    rows = {r.batch_id: (r.plate, r.blockid, r.roadid, r.districtid) for r in spark.read.parquet(out).collect()}
    assert rows == {0: ("京A1", "0001", "Five", "One"), 1: ("京A1", "0001>0002", "Five>Five", "One>One"), 2: ("京B2", "0003", "Five", "One")}
    assert spark.read.json(os.path.join(d, "json", "batch_id=1")).collect()[0].blockid == "0001>0002"


def test_processing_time_trigger_and_console(spark, capfd):
    """A live query on its trigger picks up files while it runs, and prints its batches."""
    import time

    d = tempfile.mkdtemp(prefix="roadflow-trig-")
    line = "2018-04-26\t0001\t00001\t京A1\t2018-04-26 10:00:0{i}\t50\t1\t01"
    _write_lines(os.path.join(d, "flow"), "a.tsv", [line.format(i=1)])
    totals = live.totals_stream(streams.text_flow_stream(spark, os.path.join(d, "flow")))
    queries = [live.start_to_table(totals, os.path.join(d, "out"), os.path.join(d, "ck"), "complete", {"processingTime": "1 second"}),
               live.start_console(totals, "complete", {"processingTime": "1 second"})]
    try:
        def wait_for(n):
            end = time.time() + 90
            while time.time() < end:
                for q in queries:
                    assert q.exception() is None
                if live._numbers(spark, os.path.join(d, "out"), "batch_id") and live.latest_rows(spark, os.path.join(d, "out"), []).first()[0] == n:
                    return
                time.sleep(0.5)
            raise AssertionError("no batch")

        wait_for(1)
        _write_lines(os.path.join(d, "flow"), "b.tsv", [line.format(i=2)])
        wait_for(2)
    finally:
        for q in queries:
            q.stop()


def test_streams_without_input_are_empty_and_other_errors_rise(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="roadflow-none-")
    os.makedirs(os.path.join(d, "flow"))
    stream = live.totals_stream(streams.text_flow_stream(spark, os.path.join(d, "flow")))
    assert live.run_available_now(spark, stream, "t_none", [], "complete").count() in (0, 1)
    with pytest.raises(Exception, match="(?i)path"):
        live.latest_rows(spark, os.path.join(d, "missing"), ["a"])
