"""Batch readers (S1 S2 S3) and the one line parser they share with the stream readers."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.functions.columns import java_trim, strict_date, wall_time
from roadflow.schemas import FLOW, FLOW_COLUMNS

N_FLOW_FIELDS = len(FLOW.fields)


def parse_flow_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split tab-separated flow lines into typed columns plus ``reject_reason`` (null when the row is
    good). Works the same on batch and streaming frames, all in JVM expressions.

    Reasons: ``short_line`` (fewer than 8 fields), ``bad_date`` (not yyyy-MM-dd), ``bad_time`` (not
    yyyy-MM-dd HH:mm:ss; hour 24 is the next day's hour 0), ``bad_speed`` (not an integer), ``empty_key`` (empty
    block, camera or plate). A column ``arrival_time`` of ``lines`` is kept."""
    parts = F.split(F.col(value_col).cast("string"), "\t")
    field = [java_trim(F.try_element_at(parts, F.lit(i + 1))) for i in range(N_FLOW_FIELDS)]
    typed = {
        "create_date": strict_date(field[0]),
        "block_id": field[1],
        "monitor_id": field[2],
        "plate": field[3],
        "action_time": wall_time(field[4]),
        "speed": field[5].try_cast("int"),
        "road_id": field[6],
        "area_id": field[7],
    }
    arrival = ["arrival_time"] if "arrival_time" in lines.columns else []
    df = lines.select(
        F.col(value_col).cast("string").alias("value"), F.size(parts).alias("_n"), *[v.alias(k) for k, v in typed.items()], *arrival
    )
    empty = lambda c: F.coalesce(F.length(c) == 0, F.lit(True))
    reason = (
        F.when(F.col("_n") < N_FLOW_FIELDS, "short_line")
        .when(F.col("create_date").isNull(), "bad_date")
        .when(F.col("action_time").isNull(), "bad_time")
        .when(F.col("speed").isNull(), "bad_speed")
        .when(empty(F.col("block_id")) | empty(F.col("monitor_id")) | empty(F.col("plate")), "empty_key")
    )
    return df.select("value", *FLOW_COLUMNS, *arrival, reason.alias("reject_reason"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted typed flow, rejected raw lines with reason). The caller persists ``parsed`` (or writes it)
    when both sides are consumed, so the text is parsed once."""
    good = parsed.where(F.col("reject_reason").isNull()).drop("value", "reject_reason")
    bad = parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")
    return good, bad


def parse_flow_text(spark: SparkSession, path: str) -> DataFrame:
    """The flow log as text, parsed and trimmed, with ``reject_reason``; split with ``split_rejects``."""
    return parse_flow_lines(spark.read.text(path))


def ingest_flow_tsv(spark: SparkSession, path: str, out_path: str, reject_path: str, ingest_id: str | None = None) -> None:
    """R5 R6 as a job: accepted rows of the text into a table partitioned by ``create_date``, rejected lines with
    their reason into a table partitioned by ``ingest_id`` (by default a digest of the input path).

    An ingest replaces the days it holds and its own rejects, and nothing else: other days and other ingests'
    rejects stay, and running one again doubles nothing. The text is read once for each table instead of being
    staged. The ``rebalance`` hint lets AQE write about one file per day and split a hot day over several
    tasks."""
    good, bad = split_rejects(parse_flow_text(spark, path))
    label = ingest_id if ingest_id is not None else md5(path.encode()).hexdigest()[:12]
    for df, part, to in ((good, "create_date", out_path), (bad.withColumn("ingest_id", F.lit(label)), "ingest_id", reject_path)):
        w = df.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy(part).parquet(to)


def parse_registry_text(spark: SparkSession, path: str) -> DataFrame:
    """``block<TAB>camera`` lines, trimmed, with ``reject_reason`` for lines without both fields."""
    parts = F.split(F.col("value"), "\t")
    df = spark.read.text(path).select(
        "value",
        java_trim(F.try_element_at(parts, F.lit(1))).alias("block_id"),
        java_trim(F.try_element_at(parts, F.lit(2))).alias("monitor_id"),
    )
    whole = (F.length("block_id") > 0) & (F.length("monitor_id") > 0)
    return df.withColumn("reject_reason", F.when(F.coalesce(whole, F.lit(False)), F.lit(None).cast("string")).otherwise("short_line"))


def read_flow_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Stored flow (parquet, optionally partitioned by ``create_date``); filters on ``create_date`` prune
    partitions and other predicates are pushed to the scan."""
    return spark.read.parquet(path)


def read_jdbc_table(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None) -> DataFrame:
    """S3: a dimension table over JDBC. Credentials and driver come from ``options`` (never defaults).
    For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions`` so the
    read is split over executors."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def parse_request_values(requests: DataFrame, value_col: str = "value") -> DataFrame:
    """Request / watch-list messages ``{"plate":"..."}`` -> plate; empty plates are skipped."""
    plate = F.get_json_object(F.col(value_col).cast("string"), "$.plate")
    return requests.select(java_trim(plate).alias("plate")).where(F.length("plate") > 0)
