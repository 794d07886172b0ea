"""The live job as one query (T5 T9 G8 G9 G10 K3): one read of the sighting stream, one ``foreachBatch`` that commits
speeds, totals, provinces and the three documents together.

A batch is reduced once, to one row per (pane, block, plate prefix, local). Those rows are added to the state of the
batch before, and the documents are made from the new state, so a batch costs the same after five batches as after a
year: it reads the batch and one state table whose size is bounded by the panes still open, the blocks and the
plate prefixes. Below ``out_dir``:

versions/batch_id=N/state      the running sums after batch N: open panes per block, sightings per plate prefix
versions/batch_id=N/documents  the documents of batch N, a JSON line each
closed/batch_id=N              panes that batch N closed; a later sighting of such a pane is one more partial
commits/N                      written last: batch N is complete; holds the end of the closed panes

Readers take the newest commit and what belongs to it, so no two documents come from different batches, and a batch
that was cut short is not seen. A replayed batch starts from the state before it and gives the same again. Versions
before the last one are removed.

Speeds are kept as sums per pane (the greatest common divisor of window size and slide), so a sighting is added up
once however many windows overlap; windows are put together from panes when they are read.
"""

from __future__ import annotations

import json
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.operators import province as prov
from roadflow.session import list_names, read_text, remove_path, write_text
from roadflow.streaming import live
from roadflow.streaming.sources import event_time

SUMS = ["speed_sum", "speed_count", "sightings"]
STATE_KEYS = ["pane", "block_id", "prefix", "is_local"]
STATE = "pane bigint, block_id string, prefix string, is_local boolean, speed_sum bigint, speed_count bigint, sightings bigint"
DOCUMENTS = ("live_web", "live_chart", "province")


# --- panes (G9 T2) -------------------------------------------------------------------------------------------

def micros(spark: SparkSession, interval: str) -> int:
    """Microseconds of an interval such as ``20 seconds``."""
    return spark.sql(f"select unix_micros(timestamp_seconds(0) + interval {interval}) as n").first().n


def pane_length(spark: SparkSession, size: str, slide: str) -> int:
    return gcd(micros(spark, size), micros(spark, slide))


def pane_of(ts: Column, length: int) -> Column:
    """Start of the pane of a timestamp, in microseconds."""
    at = F.unix_micros(ts)
    return at - F.pmod(at, F.lit(length))


def pane_sums(flow: DataFrame, length: int, time: str = "arrival_time") -> DataFrame:
    """One row per pane and block with sums of its sightings. Panes do not overlap, so no sighting is copied."""
    ev = event_time(flow, time)
    return ev.groupBy(pane_of(F.col("event_ts"), length).alias("pane"), "block_id").agg(
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"), F.count(F.lit(1)).alias("sightings")
    )


def window_speeds(panes: DataFrame, size: int, slide: int) -> DataFrame:
    """Window means put together from pane sums. A pane's row goes to each window that covers the pane;
    windows start at multiples of the slide."""
    length = gcd(size, slide)
    last = F.floor(F.col("pane") / slide)
    first = F.ceil((F.col("pane") + (length - size)) / slide)
    covered = panes.withColumn("k", F.explode(F.sequence(first, last)))
    start = F.timestamp_micros(F.col("k") * slide).cast("timestamp_ntz")
    end = F.timestamp_micros(F.col("k") * slide + size).cast("timestamp_ntz")
    sums = covered.groupBy(start.alias("window_start"), end.alias("window_end"), F.col("block_id").alias("blockid")).agg(
        *[F.sum(c).alias(c) for c in SUMS]
    )
    return sums.select(*live.SPEED_KEYS, F.expr("speed_sum div speed_count").alias("avg_speed"), "sightings")


# --- one batch ------------------------------------------------------------------------------------------------

def batch_sums(batch: DataFrame, length: int, local_prefix: str, time: str) -> DataFrame:
    """State rows of a batch: the sightings are grouped once, and the few rows of that split into pane rows (block
    set) and plate rows (prefix set). A line that was not accepted counts for its plate only."""
    sound = F.col("reject_reason").isNull() if "reject_reason" in batch.columns else F.lit(True)
    ev = event_time(batch, time)
    once = ev.groupBy(
        F.when(sound, pane_of(F.col("event_ts"), length)).alias("pane"),
        F.when(sound, F.col("block_id")).alias("block_id"),
        F.substring("plate", 1, 1).alias("prefix"),
        F.col("plate").startswith(local_prefix).alias("is_local"),
    ).agg(F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"), F.count(F.lit(1)).alias("sightings"))
    speeds = F.struct("pane", "block_id", F.lit(None).cast("string").alias("prefix"), F.lit(None).cast("boolean").alias("is_local"), *SUMS)
    plates = F.struct(
        F.lit(None).cast("bigint").alias("pane"), F.lit(None).cast("string").alias("block_id"), "prefix", "is_local",
        F.lit(0).cast("bigint").alias("speed_sum"), F.lit(0).cast("bigint").alias("speed_count"), "sightings",
    )
    both = F.array(F.when(F.col("pane").isNotNull(), speeds), F.when(F.col("prefix").isNotNull(), plates))
    rows = once.select(F.inline(F.filter(both, lambda x: x.isNotNull())))
    return rows.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def _commits(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n) for n in list_names(spark, f"{base}/commits") if n.isdigit())


def _commit(spark: SparkSession, base: str, batch_id: int) -> dict:
    return json.loads(read_text(spark, f"{base}/commits/{batch_id}"))


def _state(spark: SparkSession, base: str, batch_id: int) -> DataFrame:
    """The running sums after a batch, closed panes left out."""
    cutoff = _commit(spark, base, batch_id)["cutoff"]
    rows = spark.read.schema(STATE).parquet(f"{base}/versions/batch_id={batch_id}/state")
    return rows.where(F.col("pane").isNull() | (F.col("pane") >= cutoff))


def totals_of(state: DataFrame) -> DataFrame:
    """G8 from the state: one row."""
    plates = state.where(F.col("pane").isNull())
    return plates.agg(
        F.coalesce(F.sum("sightings"), F.lit(0)).alias("current_auto_count"),
        F.coalesce(F.sum(F.when(~F.col("is_local"), F.col("sightings"))), F.lit(0)).alias("current_inbound_auto"),
    )


def prefixes_of(state: DataFrame) -> DataFrame:
    """G10 from the state: sightings per plate prefix."""
    return state.where(F.col("prefix").isNotNull()).groupBy("prefix").agg(F.sum("sightings").alias("sightings"))


def _documents(state: DataFrame, size: int, slide: int, run_date: str | None) -> DataFrame:
    """The three documents (name, JSON) of a state. Only the newest window's panes are put together: the others
    are left out by their start."""
    spark = state.sparkSession
    newest = state.agg(F.max("pane")).scalar()
    speeds = window_speeds(state.where(F.col("pane") > newest - size), size, slide)
    row = live.totals_with_ranking(totals_of(state), speeds, run_date)
    made = [F.struct(F.lit(n).alias("name"), F.to_json(F.struct(*columns)).alias("document")) for n, columns in (("live_web", live.web_columns()), ("live_chart", live.chart_columns()))]
    province = prov.province_snapshot(prov.fold_provinces(spark, prefixes_of(state)))
    return row.select(F.inline(F.array(*made))).unionByName(province.select(F.lit("province").alias("name"), F.to_json(F.struct("*")).alias("document")))


class LiveBatch:
    """What ``foreachBatch`` runs: ``size``, ``slide`` and ``keep`` in microseconds. Panes that end ``keep`` before
    the newest one leave the state."""

    def __init__(self, out_dir: str, size: int, slide: int, keep: int, local_prefix: str, time: str, run_date: str | None):
        self.base = out_dir.rstrip("/")
        self.size, self.slide, self.keep = size, slide, max(keep, size)
        self.local_prefix, self.time, self.run_date = local_prefix, time, run_date

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, base = batch.sparkSession, self.base
        done = _commits(spark, base)
        if batch_id in done:
            return  # all of it is written; only the stream's own commit was lost
        before = [n for n in done if n < batch_id]
        rows = batch_sums(batch, gcd(self.size, self.slide), self.local_prefix, self.time)
        if before:
            rows = rows.unionByName(_state(spark, base, before[-1])).groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        version = f"{base}/versions/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(f"{version}/state")
        state = spark.read.schema(STATE).parquet(f"{version}/state")
        newest = state.agg(F.max("pane").alias("newest")).first().newest
        cutoff = 0 if newest is None else newest - self.keep
        if before:
            cutoff = max(cutoff, _commit(spark, base, before[-1])["cutoff"])
        closed = state.where(F.col("pane") < cutoff)
        if newest is not None and not closed.isEmpty():
            closed.select("pane", "block_id", *SUMS).write.mode("overwrite").parquet(f"{base}/closed/batch_id={batch_id}")
        _documents(state, self.size, self.slide, self.run_date).coalesce(1).write.mode("overwrite").json(f"{version}/documents")
        write_text(spark, f"{base}/commits/{batch_id}", json.dumps({"cutoff": cutoff}))
        for old in before[:-1]:  # the version before stays for readers that began on it
            remove_path(spark, f"{base}/commits/{old}")
            remove_path(spark, f"{base}/versions/batch_id={old}")


def start_live(
    flow: DataFrame,
    out_dir: str,
    size: str = live.WINDOW,
    slide: str = live.SLIDE,
    keep: str = "1 hour",
    local_prefix: str = "黑A",
    trigger: dict | None = None,
    time: str = "arrival_time",
    run_date: str | None = None,
):
    """Start the live job on a sighting stream. ``flow`` may be a parsed stream with its ``reject_reason``: then
    totals and provinces count every line with a plate, speeds the accepted ones. ``keep``: how long a pane stays
    in the state after newer ones. Returns the query; read results with ``read_live`` and ``read_document``."""
    spark = flow.sparkSession
    handle = LiveBatch(out_dir, micros(spark, size), micros(spark, slide), micros(spark, keep), local_prefix, time, run_date)
    w = flow.writeStream.option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
    return w.trigger(**(trigger or {"processingTime": live.SPEED_TRIGGER})).foreachBatch(handle).start()


# --- readers ----------------------------------------------------------------------------------------------------

def newest_documents(spark: SparkSession, out_dir: str) -> DataFrame:
    """All ``DOCUMENTS`` (name, JSON text) as of the newest committed batch."""
    base = out_dir.rstrip("/")
    return spark.read.schema("name string, document string").json(f"{base}/versions/batch_id={_commits(spark, base)[-1]}/documents")


def read_document(spark: SparkSession, out_dir: str, name: str, schema: str) -> DataFrame:
    """One of ``DOCUMENTS`` in typed columns."""
    rows = newest_documents(spark, out_dir)
    return rows.where(F.col("name") == name).select(F.from_json("document", schema).alias("d")).select("d.*")


def read_live(spark: SparkSession, out_dir: str, size: str = live.WINDOW, slide: str = live.SLIDE, run_date: str | None = None) -> dict[str, DataFrame]:
    """Results as of the newest committed batch: all ``window_speed`` (closed panes and open ones), ``totals``,
    zero-filled ``provinces`` and the ``snapshot`` row."""
    base = out_dir.rstrip("/")
    at = _commits(spark, base)[-1]
    state = _state(spark, base, at)
    panes = state.where(F.col("pane").isNotNull()).select("pane", "block_id", *SUMS)
    closed = live.current_rows(spark, f"{base}/closed", at)
    if closed is not None:
        panes = panes.unionByName(closed.select(*panes.columns))
    speeds, totals = window_speeds(panes, micros(spark, size), micros(spark, slide)), totals_of(state)
    return {
        "window_speed": speeds,
        "totals": totals,
        "provinces": prov.fold_provinces(spark, prefixes_of(state)),
        "snapshot": live.live_snapshot(totals, speeds, run_date),
    }


def compact_closed(spark: SparkSession, out_dir: str, remove: bool = False) -> int:
    """Add up the closed panes written since the last compaction (see ``live.compact``)."""
    base = out_dir.rstrip("/")
    return live.compact(spark, f"{base}/closed", None, remove, ["pane", "block_id"], _commits(spark, base)[-1])
