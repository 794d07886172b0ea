"""The sighting store (S1 R5 R6 K1): text parsed once into segments, each visible from its commit on, and small
segments packed into files of a chosen size.

A segment is one ingest's accepted and rejected lines, written by the tasks that parse the text, without a shuffle;
there is no folder per day. Packing sorts by day, so packed files hold runs of days and their statistics prune a scan
by date. Below a store's path:

segments/<name>/accepted=true|false   the lines of one ingest, or of several packed ones
commits/<number>                      {"segments": [...]}: the segments of that state, oldest first

A commit lists all segments and is moved into place whole, so a reader sees all of an ingest or nothing, and what it
has opened stays readable while others are written. An ingest that was killed leaves a segment no commit names; run
again it is written anew. An ingest that is already committed does nothing. Of two segments that hold the same day,
the later one has it: an ingest replaces the days it brings, as a whole. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from roadflow.schemas import FLOW
from roadflow.session import list_names, path_size, read_text, remove_path, write_text
from roadflow.sources.text import parse_flow_lines

TARGET = 256 << 20
SEGMENT = StructType([StructField("value", StringType()), *FLOW.fields, StructField("reject_reason", StringType()), StructField("ingest_id", StringType()), StructField("accepted", BooleanType())])
SEGMENT_COLUMNS = [f.name for f in SEGMENT.fields]


def _state(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """Number and segments of the newest commit."""
    numbers = [int(n) for n in list_names(spark, f"{path}/commits") if n.isdigit()]
    if not numbers:
        return -1, []
    return max(numbers), json.loads(read_text(spark, f"{path}/commits/{max(numbers)}"))["segments"]


def _commit(spark: SparkSession, path: str, number: int, segments: list[dict], keep: int = 5) -> None:
    write_text(spark, f"{path}/commits/{number}", json.dumps({"segments": segments}))
    old = number - keep
    if old >= 0:
        remove_path(spark, f"{path}/commits/{old}")


def _write_segment(spark: SparkSession, rows: DataFrame, path: str, name: str) -> dict:
    """Write rows as a segment; its days and size are read from what was written."""
    at = f"{path}/segments/{name}"
    rows.write.mode("overwrite").partitionBy("accepted").parquet(at)
    days = spark.read.schema(SEGMENT).parquet(at).where(F.col("accepted")).agg(F.min("create_date").alias("lo"), F.max("create_date").alias("hi"), F.count(F.lit(1)).alias("rows")).first()
    return {"name": name, "bytes": path_size(spark, at), "first": str(days.lo), "last": str(days.hi), "rows": days.rows}


def ingest(spark: SparkSession, text_path: str, store: str, ingest_id: str | None = None) -> bool:
    """Add a text's lines to a store under ``ingest_id`` (by default a digest of the text's path). False if that
    ingest is already there. The text is parsed once; accepted and rejected lines are written together."""
    store = store.rstrip("/")
    label = ingest_id or md5(text_path.encode()).hexdigest()[:12]
    number, segments = _state(spark, store)
    if any(label in s["ingests"] for s in segments):
        return False
    parsed = parse_flow_lines(spark.read.text(text_path))
    good = F.col("reject_reason").isNull()
    kept = parsed.withColumn("value", F.when(~good, F.col("value"))).withColumn("accepted", good).withColumn("ingest_id", F.lit(label))
    segment = _write_segment(spark, kept.select(*SEGMENT_COLUMNS), store, f"{label}-{uuid.uuid4().hex[:8]}")
    _commit(spark, store, number + 1, [*segments, segment | {"ingests": [label]}])
    return True


def _segment_rows(spark: SparkSession, store: str, segment: dict, place: int) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(f"{store}/segments/{segment['name']}").withColumn("place", F.lit(place))


def _overlap(segments: list[dict]) -> bool:
    spans = sorted((s["first"], s["last"]) for s in segments if s["rows"])
    return any(a[1] >= b[0] for a, b in zip(spans, spans[1:], strict=False))


def _current(spark: SparkSession, store: str, segments: list[dict]) -> DataFrame:
    """Accepted rows of the segments. Where their days overlap, each day is taken from the last segment that has it,
    by a join with one row per day; segments of separate days are read as they are."""
    rows = None
    for place, segment in enumerate(segments):
        part = _segment_rows(spark, store, segment, place).where(F.col("accepted"))
        rows = part if rows is None else rows.unionByName(part)
    if _overlap(segments):
        owner = rows.groupBy("create_date").agg(F.max("place").alias("place"))
        rows = rows.join(owner, ["create_date", "place"], "left_semi")
    return rows


def read_flow(spark: SparkSession, store: str) -> DataFrame:
    """The store's sightings as of its newest commit."""
    store = store.rstrip("/")
    _, segments = _state(spark, store)
    if not segments:
        raise FileNotFoundError(f"no committed segment in {store}")
    return _current(spark, store, segments).drop("value", "reject_reason", "accepted", "ingest_id", "place")


def read_rejects(spark: SparkSession, store: str) -> DataFrame:
    """Rejected lines of every ingest: ``value``, ``reject_reason``, ``ingest_id``."""
    store = store.rstrip("/")
    _, segments = _state(spark, store)
    paths = [f"{store}/segments/{s['name']}" for s in segments]
    if not paths:
        raise FileNotFoundError(f"no committed segment in {store}")
    rows = None
    for p in paths:
        part = spark.read.schema(SEGMENT).parquet(p).where(~F.col("accepted")).select("value", "reject_reason", "ingest_id")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def pack(spark: SparkSession, store: str, target: int = TARGET) -> int:
    """Put segments smaller than ``target`` together, oldest first, into segments of whole files of about ``target``
    bytes. Only neighbours are packed, so later segments still replace earlier days. Returns the segments left.

    Files that no commit names any more are left for ``clean``, so a reader that began before goes on."""
    store = store.rstrip("/")
    number, segments = _state(spark, store)
    bins: list[list[dict]] = []
    for s in segments:
        if bins and s["bytes"] < target and all(x["bytes"] < target for x in bins[-1]):
            bins[-1].append(s)
        else:
            bins.append([s])
    if all(len(b) == 1 for b in bins):
        return len(segments)
    packed = []
    for group in bins:
        if len(group) == 1:
            packed.append(group[0])
            continue
        good = _current(spark, store, group).drop("place")
        rejects = None
        for s in group:
            part = spark.read.schema(SEGMENT).parquet(f"{store}/segments/{s['name']}").where(~F.col("accepted"))
            rejects = part if rejects is None else rejects.unionByName(part)
        files = max(1, -(-sum(s["bytes"] for s in group) // target))
        rows = good.unionByName(rejects).select(*SEGMENT_COLUMNS)
        by_day = rows.repartitionByRange(files, "create_date", "plate").sortWithinPartitions("create_date", "plate")  # a hot day is split
        segment = _write_segment(spark, by_day, store, f"packed-{uuid.uuid4().hex[:8]}")
        packed.append(segment | {"ingests": [i for s in group for i in s["ingests"]]})
    _commit(spark, store, number + 1, packed)
    return len(packed)


def clean(spark: SparkSession, store: str) -> int:
    """Remove segments the newest commit does not name: replaced ones and those of killed ingests. Run it when no
    reader of an older state and no ingest is at work. Returns how many were removed."""
    store = store.rstrip("/")
    _, segments = _state(spark, store)
    named = {s["name"] for s in segments}
    stale = [n for n in list_names(spark, f"{store}/segments") if n not in named]
    for n in stale:
        remove_path(spark, f"{store}/segments/{n}")
    return len(stale)
