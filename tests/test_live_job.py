"""The live job: one source read and one commit per batch, replayable, at constant cost."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from roadflow.session import list_names, path_exists
from roadflow.streaming import live, live_job
from roadflow.streaming import sources as streams


def lines_of(k, n=12):
    return [
        f"2018-04-26\t000{i % 2}\t{i:05d}\t{['黑A00001', '京B00002', '粤C00003'][i % 3]}\t2018-04-26 1{k % 10}:{i * 5 % 60:02d}:00\t{i * 4 + k}\t1\t01"
        for i in range(n)
    ]


def write(folder, name, lines, at):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_600_000_000 + at, 1_600_000_000 + at))


def flow(spark, d, per_batch=1):
    return streams.text_flow_parsed(spark, os.path.join(d, "flow"), max_files_per_trigger=per_batch)


def start(spark, d, out="out", **options):
    options = {"size": "1 hour", "slide": "30 minutes", "keep": "1 hour", "trigger": {"availableNow": True}, "time": "action_time", "run_date": "2018-04-27"} | options
    return live_job.start_live(streams.with_plate(flow(spark, d)), os.path.join(d, out), **options)


def documents(spark, out):
    return {r["name"]: json.loads(r.document) for r in live_job.newest_documents(spark, out).collect()}


def test_results_of_several_batches(spark):
    d = tempfile.mkdtemp(prefix="roadflow-lj-")
    for k in range(4):
        broken = ["2018-04-26\t0001\t1\t京B00009\tno time\t5\t1\t01", "short"]
        write(f"{d}/flow", f"{k}.tsv", lines_of(k) + broken, k)
    query = start(spark, d)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4 * 14  # each line is read once for all outputs
    batch = streams.accepted(streams.parse_flow_lines(spark.read.text(f"{d}/flow")))
    want = live._window_columns(
        live._by_window(streams.event_time(batch), "1 hour", "30 minutes").agg(F.expr("sum(speed) div count(speed)").alias("avg_speed"), F.count(F.lit(1)).alias("sightings")),
        "avg_speed", "sightings",
    )
    out = f"{d}/out"
    got = live_job.read_live(spark, out, "1 hour", "30 minutes", "2018-04-27")
    assert path_exists(spark, f"{out}/closed")  # the first hours have left the state
    assert sorted(map(tuple, got["window_speed"].collect())) == sorted(map(tuple, want.collect()))
    assert tuple(got["totals"].first()) == (52, 36)  # the line without a time counts, the short one has no plate
    assert {r.province: r.sightings for r in got["provinces"].collect()} == {"黑龙江": 16, "北京": 20, "other": 16} | dict.fromkeys(["上海", "海南", "辽宁", "吉林", "福建"], 0)
    found = documents(spark, out)
    assert found["live_web"]["currentAutoCount"] == 52 and found["live_chart"]["currenAutoCount"] == 52
    assert found["province"]["provinceCount"].split("|")[:2] == ["16", "20"]
    last = want.where(F.col("window_start") == want.agg(F.max("window_start")).scalar()).orderBy(F.desc("avg_speed"), "blockid").collect()
    assert found["live_chart"]["blockRank"] == "|".join(r.blockid for r in last)
    assert live_job.compact_closed(spark, out, remove=True) >= 1
    again = live_job.read_live(spark, out, "1 hour", "30 minutes")["window_speed"]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))


def test_replayed_batch_gives_the_same(spark):
    """A batch that is cut short before its commit is not seen, and runs again to the same documents and sums; one that
    was committed is not added twice."""
    d = tempfile.mkdtemp(prefix="roadflow-replay-")
    out = f"{d}/out"
    hour = 3_600_000_000
    handle = live_job.LiveBatch(out, hour, hour // 2, hour, "黑A", "action_time", "2018-04-27")
    batches = [streams.parse_flow_lines(spark.createDataFrame([(x,) for x in lines_of(k)], "value string")) for k in (0, 2, 4)]
    handle(batches[0], 0)
    handle(batches[1], 1)
    before = documents(spark, out)

    commit = live_job.write_text
    try:
        live_job.write_text = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
        try:
            handle(batches[2], 2)
        except RuntimeError:
            pass
    finally:
        live_job.write_text = commit
    assert path_exists(spark, f"{out}/versions/batch_id=2/documents") and documents(spark, out) == before
    closed_then = {tuple(r) for r in live_job.read_live(spark, out, "1 hour", "30 minutes")["window_speed"].collect()}
    handle(batches[2], 2)
    after = documents(spark, out)
    handle(batches[2], 2)
    assert documents(spark, out) == after and after["live_web"]["currentAutoCount"] == 36 != before["live_web"]["currentAutoCount"]
    now = live_job.read_live(spark, out, "1 hour", "30 minutes")["window_speed"].collect()
    assert sum(r.sightings for r in now) == 72 and closed_then <= {tuple(r) for r in now}


def test_cost_does_not_grow_with_the_number_of_batches(spark):
    """After 5 and after 15 batches a batch reads one state table of as many rows and keeps as many folders."""
    d = tempfile.mkdtemp(prefix="roadflow-flat-")
    out = f"{d}/out"
    hour = 3_600_000_000
    handle = live_job.LiveBatch(out, hour // 2, hour // 4, hour, "黑A", "action_time", "2018-04-27")
    seen = {}
    for k in range(15):
        t = f"2018-04-{1 + k // 20:02d} {k % 20:02d}:30:00"
        rows = [f"2018-04-26\t000{i}\t1\t京B0000{i}\t{t}\t50\t1\t01" for i in range(4)]
        handle(streams.parse_flow_lines(spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1)), k)
        if k in (4, 14):
            state = spark.read.parquet(f"{out}/versions/batch_id={k}/state")
            seen[k] = (state.count(), len(state.inputFiles()) <= 8, len(list_names(spark, f"{out}/versions")), len(list_names(spark, f"{out}/commits")))
    assert seen[4] == seen[14] and seen[14][1:] == (True, 2, 2)
    assert live_job.read_live(spark, out, "30 minutes", "15 minutes")["totals"].first()[0] == 60


def test_panes_are_windows_without_copies(spark):
    """Size not a multiple of the slide; no operator above the scan multiplies rows."""
    rows = spark.range(500).select(
        F.timestamp_seconds(F.col("id") * 37).cast("timestamp_ntz").alias("action_time"), (F.col("id") % 3).cast("string").alias("block_id"), (F.col("id") % 90).cast("int").alias("speed")
    )
    size, slide = (live_job.micros(spark, x) for x in ("50 seconds", "20 seconds"))
    panes = live_job.pane_sums(rows, live_job.pane_length(spark, "50 seconds", "20 seconds"), "action_time")
    plan = panes._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    got = live_job.window_speeds(panes, size, slide)
    want = live._window_columns(
        live._by_window(streams.event_time(rows), "50 seconds", "20 seconds").agg(F.expr("sum(speed) div count(speed)").alias("avg_speed"), F.count(F.lit(1)).alias("sightings")),
        "avg_speed", "sightings",
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stream_without_sightings(spark):
    d = tempfile.mkdtemp(prefix="roadflow-quiet-")
    write(f"{d}/flow", "a.tsv", ["2018-04-26\t0001\t1\t京B1\tno time\t5\t1\t01"], 0)
    start(spark, d).awaitTermination()
    found = documents(spark, f"{d}/out")
    assert found["live_web"]["currentAutoCount"] == 1 and "speedRank" not in found["live_web"]
    assert live_job.read_live(spark, f"{d}/out")["window_speed"].count() == 0
