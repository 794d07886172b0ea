"""Stream sources (S4 S5 S6). Kafka in production; a file stream with the same parser in tests (the Kafka
connector jar is not on this classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadflow.session import configure
from roadflow.sources import fixtures as fx
from roadflow.sources.text import parse_flow_lines, parse_request_values, split_rejects


def kafka_values(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Raw Kafka records as (value string, timestamp). ``options`` carries security settings etc."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival_time"))


def accepted(parsed: DataFrame) -> DataFrame:
    """Typed sightings of a parsed stream. Its rejects go to ``start_reject_sink``."""
    return split_rejects(parsed)[0]


def with_plate(parsed: DataFrame) -> DataFrame:
    """Every parsed line with a plate, whatever else does not parse: what totals and provinces count."""
    return parsed.where(F.length("plate") > 0)


def kafka_flow_parsed(spark: SparkSession, bootstrap_servers: str, topic: str = "StreamAuto", **kw) -> DataFrame:
    """Lines of the flow topic (the record value, D11) parsed, with ``reject_reason`` and the record's
    ``arrival_time``."""
    configure(spark)
    return parse_flow_lines(kafka_values(spark, bootstrap_servers, topic, **kw))


def kafka_requests(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """Request / watch-list plates from ``{"plate": ...}`` messages, empty plates skipped."""
    return parse_request_values(kafka_values(spark, bootstrap_servers, topic, **kw))


def text_flow_parsed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S4 over a folder of tab-separated files (same parser as Kafka); a line arrives when its file does."""
    configure(spark)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = r.load(path).select("value", F.col("_metadata.file_modification_time").alias("arrival_time"))
    return parse_flow_lines(lines)


def text_flow_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The accepted sightings of ``text_flow_parsed``."""
    return accepted(text_flow_parsed(spark, path, max_files_per_trigger))


def text_request_stream(spark: SparkSession, path: str) -> DataFrame:
    """S5 over a folder of JSON-lines request files."""
    return parse_request_values(spark.readStream.format("text").load(path))


def events_flow_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings streamed from the ``events`` parquet table (view ``flow_events``), for tests and checks."""
    return events_folder_stream(spark, sf_dir, fx.table(spark, sf_dir, "events").schema, "events.parquet")


def events_folder_stream(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet") -> DataFrame:
    """Sightings streamed from files of ``events`` rows; a row's ``ts`` is also when it arrived."""
    configure(spark)
    events = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    return fx.events_to_flow(events)


def event_time(df: DataFrame, col: str = "action_time") -> DataFrame:
    """Watermarks need a zoned timestamp; camera wall-clock time is read as UTC (session zone is UTC)."""
    return df.withColumn("event_ts", F.col(col).cast("timestamp"))


def start_reject_sink(parsed: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None):
    """R5 for streams: the lines of a parsed stream that were not accepted (with their reason) appended to a
    parquet table, the same split the batch ingest makes."""
    _, bad = split_rejects(parsed)
    w = bad.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
