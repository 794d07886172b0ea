"""Watch messages joined with sightings on two streams, first sightings, and state read back."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from roadflow.streaming import joins, live
from roadflow.streaming import sources as streams

LINE = "2018-04-26\t000{b}\t00001\t{p}\t{t}\t{s}\t1\t01"


def write(folder, name, lines, at):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(os.path.join(folder, name), (1_600_000_000 + at, 1_600_000_000 + at))


def sighting(p, t, b=1, s=50):
    return LINE.format(p=p, t=f"2018-04-{t}", b=b, s=s)


def asked(p, t):
    return json.dumps({"plate": p, "asked_at": f"2018-04-{t}"}, ensure_ascii=False)


def watch_stream(spark, path):
    return spark.readStream.schema("plate string, asked_at timestamp_ntz").json(path)


def test_two_streams_meet_within_the_interval_and_state_shrinks(spark):
    d = tempfile.mkdtemp(prefix="roadflow-ss-")

    def run():
        flow = streams.text_flow_stream(spark, f"{d}/flow")
        stream = joins.watched_sightings(flow, watch_stream(spark, f"{d}/watch"), "1 hour", "5 minutes")
        with live.state_partitions_for_start(spark, 2):
            q = live.start_append(stream, f"{d}/out", f"{d}/ck", {"availableNow": True})
        q.awaitTermination()
        done = [p for p in q.recentProgress if p["stateOperators"]]
        return done[-1]["stateOperators"][0]["numRowsTotal"] if done else None

    def found():
        return sorted((r.plate, str(r.asked_at)[11:16], str(r.time)[11:16]) for r in spark.read.parquet(f"{d}/out").collect())

    os.makedirs(f"{d}/watch")
    write(f"{d}/flow", "0.tsv", [sighting("京A1", "26 10:00:00"), sighting("京A1", "26 10:01:00"), sighting("沪B2", "26 10:02:00")], 0)
    write(f"{d}/watch", "0.json", [asked("京A1", "26 10:01:00"), asked("", "26 10:01:00"), asked("京A1", "26 10:30:00")], 0)
    run()
    assert found() == [("京A1", "10:01", "10:01")]  # not the sighting before the message
    # the message of 10:01 was read in an earlier run; its interval is still open for 10:50 and closed at 11:02
    write(f"{d}/flow", "1.tsv", [sighting("京A1", "26 10:50:00"), sighting("京A1", "26 11:02:00", 2)], 1)
    write(f"{d}/watch", "1.json", [asked("沪B2", "26 10:59:00")], 1)
    held = run()
    want = [("京A1", "10:01", "10:01"), ("京A1", "10:01", "10:50"), ("京A1", "10:30", "10:50"), ("京A1", "10:30", "11:02")]
    assert found() == want
    # half a day later nothing of the morning is left: two rows came in, fewer than before are held
    write(f"{d}/flow", "2.tsv", [sighting("京A1", "26 23:00:00")], 2)
    write(f"{d}/watch", "2.json", [asked("闽C3", "26 23:00:00")], 2)
    left = run()
    assert found() == want and left < held and left <= 2


def test_first_sighting_once_per_vehicle(spark):
    """Several batches and restarts: once per vehicle, the earliest of its first batch, ties by place; local
    vehicles never; a vehicle that stayed away past ``keep`` again."""
    d = tempfile.mkdtemp(prefix="roadflow-fs-")

    def run(keep="2 hours"):
        flow = streams.text_flow_stream(spark, f"{d}/flow", max_files_per_trigger=1)
        with live.state_partitions_for_start(spark, 2):
            q = live.start_append(joins.first_sightings(flow, keep, "1 minute"), f"{d}/out", f"{d}/ck", {"availableNow": True})
        q.awaitTermination()
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    def found():
        return sorted((r.plate, str(r.first_time)[8:16], r.first_inbound_position) for r in spark.read.schema(joins.FIRST).parquet(f"{d}/out").collect())

    write(f"{d}/flow", "0.tsv", [sighting("京A1", "26 10:05:00", 3), sighting("京A1", "26 10:00:00", 2), sighting("京A1", "26 10:00:00", 1), sighting("黑A9", "26 10:00:00")], 0)
    write(f"{d}/flow", "1.tsv", [sighting("京A1", "26 10:10:00"), sighting("沪B2", "26 10:11:00")], 1)
    run()
    assert found() == [("京A1", "26 10:00", "0001"), ("沪B2", "26 10:11", "0001")]
    write(f"{d}/flow", "2.tsv", [sighting("沪B2", "26 12:00:00")], 2)
    run()  # both are known still
    write(f"{d}/flow", "3.tsv", [sighting("闽C3", "26 13:30:00")], 3)
    assert run() == 2 and len(found()) == 3  # 京A1 was last seen at 10:10 and left the state
    write(f"{d}/flow", "4.tsv", [sighting("京A1", "26 13:40:00", 4), sighting("沪B2", "26 13:41:00")], 4)
    run()
    assert found() == [("京A1", "26 10:00", "0001"), ("京A1", "26 13:40", "0004"), ("沪B2", "26 10:11", "0001"), ("闽C3", "26 13:30", "0001")]


def test_state_reader_is_the_final_state(spark):
    """Totals, provinces and open windows from the checkpoint equal what the batches gave, and what is read does not
    grow with the batches."""
    d = tempfile.mkdtemp(prefix="roadflow-state-")
    files = {}
    for k in range(12):
        write(f"{d}/flow", f"{k:02d}.tsv", [sighting(p, f"26 1{k // 6}:{k % 6}{i}:00", i, 10 * i) for i, p in enumerate(["京A1", "黑A2", "粤C3"])], k)
        if k not in (2, 11):
            continue
        flow = streams.text_flow_stream(spark, f"{d}/flow", max_files_per_trigger=1)
        plans = {
            "totals": (live.totals_stream(flow), "complete", []),
            "prefixes": (live.province_prefix_stream(flow), "update", ["prefix"]),
            "windows": (live.window_speed_stream(flow, "20 minutes", "10 minutes", "1 day", "action_time"), "update", live.SPEED_KEYS),
        }
        for name, (stream, mode, keys) in plans.items():
            live.start_to_table(stream, f"{d}/{name}", f"{d}/{name}-ck", mode, {"availableNow": True}, state_partitions=2).awaitTermination()
            got = {"totals": joins.running_totals, "prefixes": joins.running_prefixes, "windows": joins.running_windows}[name](spark, f"{d}/{name}-ck")
            want = live.latest_rows(spark, f"{d}/{name}", keys)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())), name
            files.setdefault(name, []).append(got.rdd.getNumPartitions())
    assert all(a == b <= 2 for a, b in files.values())  # parts of the state, not batches


def test_first_sightings_keep_missing_values(spark):
    rows = spark.createDataFrame([("京A1", None, None), ("京A1", "0001", "5")], "plate string, block_id string, road_id string")
    path = tempfile.mkdtemp(prefix="roadflow-null-") + "/in"
    rows.select("*", F.lit("1").alias("monitor_id"), F.lit("1").alias("area_id"), F.lit(1).alias("speed"), F.expr("timestamp_ntz'2018-04-26 10:00:00'").alias("action_time")).coalesce(1).write.parquet(path)
    flow = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    got = live.run_available_now(spark, joins.first_sightings(flow), "t_null", None, state_partitions=2).collect()
    assert [(r.plate, r.first_inbound_position) for r in got] == [("京A1", None)]  # a missing block sorts first
