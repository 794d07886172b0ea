"""Text helpers of the reference re-aimed as jobs (R5 R8 R9 R10 R11). The packed text columns are built
from flow columns, so the jobs grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.functions import columns as C
from roadflow.sources import text as tx


def flow_lines(flow: DataFrame) -> DataFrame:
    """Flow rows written back as the reference's tab-separated lines. Speed 0 is written as ``n/a`` and
    the out-of-map plate letter as an empty plate, so the reject path of the ingest has work."""
    speed = F.when(F.col("speed") == 0, F.lit("n/a")).otherwise(F.col("speed").cast("string"))
    plate = F.when(F.col("plate").startswith("粤"), F.lit("")).otherwise(F.col("plate"))
    return flow.select(
        F.concat_ws(
            "\t",
            F.date_format("create_date", "yyyy-MM-dd"),
            "block_id",
            "monitor_id",
            plate,
            F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"),
            speed,
            "road_id",
            "area_id",
        ).alias("value")
    )


def typed_ingest_counts(flow: DataFrame) -> DataFrame:
    """Parse the lines, split accepted from rejected, count each reason."""
    parsed = tx.parse_flow_lines(flow_lines(flow))
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("status")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def fixed_width_ids(flow: DataFrame) -> DataFrame:
    """R8 over distinct (order, road) keys: order key at width 4 (longer keys stay whole), road id with
    the one-argument pad."""
    keys = flow.select(F.col("order_key").cast("string").alias("order_key"), "road_id").distinct()
    return keys.select(
        "order_key",
        C.fixed_width("order_key", 4).alias("order_key_4"),
        "road_id",
        C.pad_single("road_id").alias("road_id_2"),
    )


def packed_text(flow: DataFrame) -> F.Column:
    """``speed=s|road=r|x=1=2|bad=|lane=a=|speed=s+1`` from flow columns: a repeated key, a three-part
    entry, an empty value and a trailing ``=`` in every row."""
    return F.concat(
        F.lit("speed="), F.col("speed").cast("string"),
        F.lit("|road="), F.col("road_id"),
        F.lit("|x=1=2|bad=|lane="), F.col("area_id"),
        F.lit("=|speed="), (F.col("speed") + 1).cast("string"),
    )


def kv_expand(flow: DataFrame) -> DataFrame:
    """Expand the packed text into a map (last duplicate wins) and read one field (first match)."""
    t = flow.select("order_key", "line_no", packed_text(flow).alias("attrs"))
    # The map is built once per row in its own projection; the fields are read from it afterwards.
    parsed = t.select("order_key", "line_no", C.kv_field("attrs", "speed").alias("speed_first"), C.kv_map("attrs").alias("m"))
    return parsed.select(
        "order_key",
        "line_no",
        "speed_first",
        F.col("m")["speed"].alias("speed_last"),
        F.col("m")["road"].alias("road"),
        F.col("m")["lane"].alias("lane"),
        F.size("m").cast("bigint").alias("n_keys"),
    )


def kv_update(flow: DataFrame) -> DataFrame:
    """Set the first ``speed`` entry to the speed band name of the row."""
    from roadflow.operators.speed import speed_band

    band = F.coalesce(speed_band("speed"), F.lit("none"))
    return flow.select("order_key", "line_no", C.kv_set(packed_text(flow), "speed", band).alias("attrs"))


def comma_clean(flow: DataFrame) -> DataFrame:
    """``,block,camera,`` -> ``block,camera``; a lone ``,`` (rows of speed 0) -> empty."""
    raw = F.when(F.col("speed") == 0, F.lit(",")).otherwise(F.concat_ws(",", F.lit(""), "block_id", "monitor_id", F.lit("")))
    t = flow.select("order_key", "line_no", raw.alias("raw"))
    return t.select("order_key", "line_no", "raw", C.trim_comma("raw").alias("cleaned"))
