"""Speed profile per block: four band counts and the mean (G6 G7 O2 P9 R12; defects D4 D5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.operators.device import _run_date

# Band edges (fixed values): (0, 60) min, [60, 90) normal, [90, 120) med, [120, inf) high; <= 0 no band.
BAND_EDGES = (0, 60, 90, 120)


def speed_band(speed: Column | str = "speed") -> Column:
    """Band name of one speed (P9); null for speeds <= 0 (D5) and unparsable speeds."""
    s = F.col(speed) if isinstance(speed, str) else speed
    lo, normal, med, high = BAND_EDGES
    return (
        F.when((s > lo) & (s < normal), "min")
        .when((s >= normal) & (s < med), "normal")
        .when((s >= med) & (s < high), "med")
        .when(s >= high, "high")
    )


def block_speed_bands(flow: DataFrame, run_date: str | None = None) -> DataFrame:
    """Result table ``TopN_Speed``: one partial + final aggregate over (block, speed) only, ordered by
    the numeric mean (D4). Speeds <= 0 count in the mean but in no band (D5)."""
    band = speed_band("speed")
    agg = flow.groupBy(F.col("block_id").alias("blockid")).agg(
        F.count_if(band == "min").alias("min_Speed"),
        F.count_if(band == "normal").alias("normal_Speed"),
        F.count_if(band == "med").alias("med_Speed"),
        F.count_if(band == "high").alias("high_Speed"),
        F.round(F.avg("speed"), 3).alias("avg_Speed"),
    )
    return agg.select(
        _run_date(run_date).alias("create_date"),
        "blockid",
        "min_Speed",
        "normal_Speed",
        "med_Speed",
        "high_Speed",
        "avg_Speed",
    ).orderBy(F.desc("avg_Speed"), "blockid")


def speed_web(bands: DataFrame) -> DataFrame:
    """Web snapshot ``(block,mean)>(…)`` ranked by mean desc; the mean printed ``%.3f``."""
    item = F.format_string("(%s,%.3f)", F.col("blockid"), F.col("avg_Speed"))
    r = bands.groupBy("create_date").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("avg_Speed")).alias("k"), "blockid", item.alias("t")))).alias("r")
    )
    return r.select("create_date", F.array_join(F.transform("r", lambda x: x["t"]), ">").alias("avg_speed"))
