"""Sinks (K1 K2 K4 K5): result tables, one-document JSON snapshots, console and temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.session import list_names, path_exists, write_text


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """K1: append a result to a table folder (parquet by default), optionally partitioned (e.g. by
    ``create_date``), written in parallel by the tasks that computed it."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_once(df: DataFrame, path: str, run_id: str, partition_by: list[str] | None = None) -> bool:
    """K1 exactly once: append a run's result under its ``run_id``; False if that run is already there.

    A run writes a folder of its own and then its commit; readers (``read_appended``) see committed runs only. A run
    that was killed left no commit: run again, it writes its folder anew. So each run counts once, however often it
    was started."""
    spark, base = df.sparkSession, path.rstrip("/")
    if path_exists(spark, f"{base}/_commits/{run_id}"):
        return False
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{base}/run_id={run_id}")
    write_text(spark, f"{base}/_commits/{run_id}", run_id)
    return True


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All committed runs of an ``append_once`` table, with their ``run_id``."""
    base = path.rstrip("/")
    runs = [n for n in list_names(spark, f"{base}/_commits") if not n.startswith("_")]
    if not runs:
        raise FileNotFoundError(f"no committed run in {base}")
    return spark.read.option("basePath", base).parquet(*[f"{base}/run_id={n}" for n in sorted(runs)]).withColumn("run_id", F.col("run_id").cast("string"))


def append_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """K1 over JDBC. Connection settings (user, password, driver, batchsize, numPartitions) are the
    caller's; nothing is defaulted."""
    w = df.write.mode("append").format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def snapshot_json(df: DataFrame, path: str) -> None:
    """K2 F8: overwrite ``path`` with a result as JSON lines, one line per row (a packed result is one row and
    so one document). The plan runs once and every task writes what it computed."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON documents, one line per row, written in parallel by the computing tasks (for outputs that
    may be large, such as one route document per vehicle)."""
    df.write.mode("overwrite").json(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a K2 snapshot back into typed columns."""
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")


def show(df: DataFrame, n: int = 20) -> None:
    """K4: print the first rows (display only)."""
    df.show(n, truncate=False)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register the result as a temp view for SQL users (``select * from name``)."""
    df.createOrReplaceTempView(name)
    return df
