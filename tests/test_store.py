"""The flow store and the exactly-once append: killed and repeated runs, replaced days, packing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from roadflow.session import list_names
from roadflow.sinks import tables as sinks
from roadflow.sources import store


def lines(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.tsv"), "w", encoding="utf-8") as f:
        f.write("\n".join(f"{day}\t0001\t{i}\t京A{i}\t{day} 10:00:00\t{speed}\t1\t01" if day else "broken" for i, (day, speed) in enumerate(rows)) + "\n")
    return folder


def days(spark, at):
    return {(str(r.create_date), r.speed): r["count"] for r in store.read_flow(spark, at).groupBy("create_date", "speed").count().collect()}


def test_ingest_once_and_days_are_replaced_whole(spark):
    d = tempfile.mkdtemp(prefix="roadflow-store-")
    at = f"{d}/store"
    one = lines(f"{d}/1", [("2018-04-26", 1), ("2018-04-26", 1), ("2018-04-27", 1), (None, 0), ("2018-04-27", "x")])
    two = lines(f"{d}/2", [("2018-04-27", 2), ("2018-04-28", 2), (None, 0)])
    assert store.ingest(spark, one, at) and not store.ingest(spark, one, at)
    assert days(spark, at) == {("2018-04-26", 1): 2, ("2018-04-27", 1): 1}
    assert store.ingest(spark, two, at, "second") and not store.ingest(spark, two, at, "second")
    want = {("2018-04-26", 1): 2, ("2018-04-27", 2): 1, ("2018-04-28", 2): 1}
    assert days(spark, at) == want
    rejected = lambda: sorted((r.reject_reason, r.value is not None) for r in store.read_rejects(spark, at).collect())
    assert rejected() == [("bad_speed", True), ("short_line", True), ("short_line", True)]
    opened = store.read_flow(spark, at)
    assert store.pack(spark, at) == 1 and store.pack(spark, at) == 1
    assert days(spark, at) == want and rejected()[0] == ("bad_speed", True) and len(rejected()) == 3
    assert opened.count() == 4  # a reader of the earlier commit goes on
    assert not store.ingest(spark, two, at, "second")  # known after packing too
    assert store.clean(spark, at) == 2 and days(spark, at) == want
    # packing keeps the order of replacement: a third ingest has its day, then gives way to none
    assert store.ingest(spark, lines(f"{d}/3", [("2018-04-26", 3)]), at) and store.pack(spark, at) == 1
    assert days(spark, at) == {("2018-04-26", 3): 1, ("2018-04-27", 2): 1, ("2018-04-28", 2): 1}


def test_killed_ingest_is_not_seen_and_runs_again(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="roadflow-kill-")
    at, text = f"{d}/store", lines(f"{d}/1", [("2018-04-26", 1)])
    with monkeypatch.context() as m:
        m.setattr(store, "write_text", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.ingest(spark, text, at)
    with pytest.raises(FileNotFoundError):
        store.read_flow(spark, at)
    assert store.ingest(spark, text, at) and store.read_flow(spark, at).count() == 1
    assert len(list_names(spark, f"{at}/segments")) == 2 and store.clean(spark, at) == 1


def test_many_ingests_pack_into_few_files_of_bounded_size(spark):
    d = tempfile.mkdtemp(prefix="roadflow-pack-")
    at = f"{d}/store"
    for k in range(8):
        store.ingest(spark, lines(f"{d}/{k}", [(f"2018-04-{1 + 3 * k + i % 3:02d}", k) for i in range(30)]), at)
    before = store.read_flow(spark, at)
    rows, files = sorted(map(tuple, before.collect()), key=str), len(before.inputFiles())
    assert store.pack(spark, at, target=1 << 20) == 1
    after = store.read_flow(spark, at)
    assert sorted(map(tuple, after.collect()), key=str) == rows and files >= 8 and len(after.inputFiles()) == 1
    # a small target makes several files, each of a run of days, with the hot day's rows split
    store.ingest(spark, lines(f"{d}/hot", [("2018-05-01", 9)] * 3000 + [("2018-05-02", 9)] * 300), at)
    store.pack(spark, at, target=20_000)
    store.ingest(spark, lines(f"{d}/more", [("2018-05-03", 9)] * 3), at)
    sizes = [os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in store.read_flow(spark, at).inputFiles()]
    assert len(sizes) >= 3 and max(sizes) < 40_000
    plan = store.read_flow(spark, at).where(F.col("create_date") == "2018-05-03")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(create_date" in plan and "Join" not in plan


def test_append_once(spark):
    """A killed and repeated run leaves one copy."""
    path = tempfile.mkdtemp(prefix="roadflow-once-") + "/t"
    rows = spark.range(4).withColumn("day", F.col("id") % 2)
    with pytest.raises(Exception, match="stop"):
        sinks.append_once(rows.withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise("ok")), path, "r1", ["day"])
    with pytest.raises(FileNotFoundError):
        sinks.read_appended(spark, path)
    assert sinks.append_once(rows, path, "r1", ["day"]) and not sinks.append_once(rows, path, "r1", ["day"])
    assert sinks.append_once(rows, path, "20240201", ["day"])
    got = sinks.read_appended(spark, path)
    assert sorted((r.run_id, r.id) for r in got.collect()) == sorted((run, i) for run in ("20240201", "r1") for i in range(4))
    assert dict(got.dtypes)["run_id"] == "string"
