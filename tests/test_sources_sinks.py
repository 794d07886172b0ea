"""TSV readers, partitioned ingest and sink guards."""

import os
import tempfile

from pyspark.sql import functions as F

from roadflow.sinks import tables as sinks
from roadflow.sources import text as tx


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_registry_and_flow_tsv(spark):
    d = tempfile.mkdtemp(prefix="roadflow-tsv-")
    _write(f"{d}/reg", "r.tsv", ["0005\t71892", " 0001 \t 00002 ", "0003", "\t"])
    good, bad = tx.split_rejects(tx.parse_registry_text(spark, f"{d}/reg"))
    assert sorted(map(tuple, good.collect())) == [("0001", "00002"), ("0005", "71892")]
    assert sorted(map(tuple, bad.collect())) == [("\t", "short_line"), ("0003", "short_line")]

    _write(f"{d}/flow", "f.tsv", [
        "2018-04-26\t0005\t26780\t深W61995\t2018-04-26 02:44:08\t154\t47\t02",
        "2018-04-27\t0005\t43356\t深W61995\t2018-04-27 02:13:57\t174\t32\t05",
        "2018-04-27\t0005\t43356\t深W61995\tbad\t174\t32\t05",
    ])
    flow, _ = tx.split_rejects(tx.parse_flow_text(spark, f"{d}/flow"))
    assert flow.count() == 2 and dict(flow.dtypes)["action_time"] == "timestamp_ntz"

    out, rej = f"{d}/typed", f"{d}/rejects"
    tx.ingest_flow_tsv(spark, f"{d}/flow", out, rej)
    stored = spark.read.parquet(out)
    assert sorted(p for p in os.listdir(out) if p.startswith("create_date=")) == ["create_date=2018-04-26", "create_date=2018-04-27"]
    assert stored.where(F.col("create_date") == F.lit("2018-04-27").cast("date")).count() == 1
    assert [r.reject_reason for r in spark.read.parquet(rej).collect()] == ["bad_time"]


def test_ingests_replace_their_days_and_nothing_else(spark):
    """Two ingests of different days keep both, one run again doubles nothing, rejects of both stay."""
    d = tempfile.mkdtemp(prefix="roadflow-ingest-")
    line = "2018-04-{d}\t0005\t26780\t深W61995\t2018-04-{d} 02:44:08\t{s}\t47\t02"
    _write(f"{d}/a", "f.tsv", [line.format(d=26, s=1), line.format(d=26, s="x")])
    _write(f"{d}/b", "f.tsv", [line.format(d=27, s=1), line.format(d=27, s=2), "short"])
    for part in "abba":
        tx.ingest_flow_tsv(spark, f"{d}/{part}", f"{d}/flow", f"{d}/rejects")
    stored = {str(r.create_date): r["count"] for r in spark.read.parquet(f"{d}/flow").groupBy("create_date").count().collect()}
    assert stored == {"2018-04-26": 1, "2018-04-27": 2}
    assert sorted(r.reject_reason for r in spark.read.parquet(f"{d}/rejects").collect()) == ["bad_speed", "short_line"]


def test_strict_dates_and_times(spark):
    """Date only, hour only, T, zone and impossible values are rejected; hour 24 is the next day's hour 0."""
    line = "{date}\t0005\t26780\t深W61995\t{time}\t1\t47\t02"
    cases = [
        ("2018-04-26", "2018-04-26 02:44:08", None), ("2018", "2018-04-26 02:44:08", "bad_date"),
        ("2018-4-26", "2018-04-26 02:44:08", "bad_date"), ("2018-02-30", "2018-04-26 02:44:08", "bad_date"),
        ("2018-04-26", "2018-04-26", "bad_time"), ("2018-04-26", "2018-04-26T02:44:08", "bad_time"),
        ("2018-04-26", "2018-04-26 02:44:08+08:00", "bad_time"), ("2018-04-26", "2018-04-31 02:44:08", "bad_time"),
        ("2018-04-26", "2018-04-26 25:00:00", "bad_time"), ("2018-04-26", "2018-04-26 02:44", "bad_time"),
        ("2018-04-30", "2018-04-30 24:15:09", None), ("2018-04-26", " 2018-04-26 02:44:08 ", None),
    ]
    df = spark.createDataFrame([(line.format(date=a, time=t),) for a, t, _ in cases], "value string")
    got = tx.parse_flow_lines(df).collect()
    assert [r.reject_reason for r in got] == [c[2] for c in cases]
    assert str(got[10].action_time) == "2018-05-01 00:15:09" and str(got[10].create_date) == "2018-04-30"


def test_snapshot_holds_every_row(spark):
    path = tempfile.mkdtemp(prefix="roadflow-snap-") + "/s"
    rows = spark.range(0, 20_000, 1, 4).select(F.col("id").alias("a"))
    sinks.snapshot_json(rows, path)
    assert sinks.read_snapshot(spark, path, rows.schema).agg(F.count("a"), F.sum("a")).first()[:] == (20_000, 199_990_000)


def test_view_and_show(spark, capsys):
    sinks.show(sinks.as_view(spark.range(3), "three"))
    assert spark.sql("select * from three").count() == 3 and "|2" in capsys.readouterr().out


def test_request_values(spark):
    df = spark.createDataFrame([('{"plate":"黑A12345"}',), ('{"plate":""}',), ("not json",)], "value string")
    assert [r.plate for r in tx.parse_request_values(df).collect()] == ["黑A12345"]
