"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.session import scratch_path

#: The characters that separate words, as a Java character class body.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether Spark deletes the shuffle files of an execution when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written as Parquet to the folder the cluster shares, and read back.

    Cuts the lineage so that a lost executor repeats only the tasks that read the table, and so that two
    readers of an expensive step share one run of it. ``tidy``: the shuffle files of ``df``, which is not run
    again, go when it is written, not when the driver happens to collect its garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(TIDY)
    conf.set(TIDY, str(tidy or before == "true").lower())
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(TIDY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_column: str, text: Column) -> Column:
    """128 bits (two 64-bit hashes, hex) that name a row by its id and text; equal rows share it.

    A null id differs from every number.
    """
    ident = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", ident, text))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores appended until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
