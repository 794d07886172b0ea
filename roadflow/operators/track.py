"""Vehicle track: the time-ordered blocks, roads and districts of requested plates
(P3 J3 J4 J7 G11 O5; defects D17 D18 D19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.operators.device import _run_date
from roadflow.operators.joins import numeric_key
from roadflow.operators.sequence import number_by_key, ordered_join_by_key
from roadflow.schemas import TIE_BREAK


def requested_sightings(flow: DataFrame, requests: DataFrame) -> DataFrame:
    """Sightings of any requested plate, one semi join (not one scan per request). The request set
    is deduplicated first; Spark/AQE broadcast it only when its real size allows."""
    req = requests.where(F.length("plate") > 0).select("plate").distinct()
    return flow.join(req, "plate", "left_semi")


def _route(df: DataFrame, block: str, road: str, area: str) -> DataFrame:
    """Per plate, ``>`` lists of blocks, roads and districts ordered by time with a total tie-break
    (D19), built from one piece per (plate, day): a vehicle's sightings are never gathered as rows in one
    task, only its daily strings are."""
    values = {"blockid": block, "roadid": road, "districtid": area}
    return ordered_join_by_key(df, "plate", ["action_time", *TIE_BREAK], values, F.to_date("action_time"))


def vehicle_track(flow: DataFrame, requests: DataFrame, run_date: str | None = None) -> DataFrame:
    """Result table ``Auto_Track``: ids as the reference stores them (district = area id)."""
    r = _route(requested_sightings(flow, requests), "block_id", "road_id", "area_id")
    return r.select(_run_date(run_date).alias("create_date"), "plate", "blockid", "roadid", "districtid")


def _one_name_per_id(dim: DataFrame, key: str, name: str) -> DataFrame:
    """A dimension with a repeated id keeps one name for it (the smallest, so runs agree); ids that are
    not numbers cannot match and are dropped."""
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(name).alias(name))


def named_sightings(flow: DataFrame, requests: DataFrame, district: DataFrame, road: DataFrame) -> DataFrame:
    """Requested sightings with ``road_label`` / ``district_label``: each dimension joined once at
    sighting grain (not one lookup per visit, D17), on numeric ids (D18). The planner broadcasts a dimension
    from its size statistics or, at run time, its measured size; an id without a name stays as the id."""
    s = requested_sightings(flow, requests)
    d = district.select(numeric_key("district_id").alias("_area_key"), F.col("district_name"))
    rd = road.select(numeric_key("road_id").alias("_road_key"), F.col("road_name"))
    return (
        s.withColumn("_area_key", numeric_key("area_id"))
        .withColumn("_road_key", numeric_key("road_id"))
        .join(_one_name_per_id(d, "_area_key", "district_name"), "_area_key", "left")
        .join(_one_name_per_id(rd, "_road_key", "road_name"), "_road_key", "left")
        .withColumn("district_label", F.coalesce("district_name", "area_id"))
        .withColumn("road_label", F.coalesce("road_name", "road_id"))
    )


def vehicle_track_named(
    flow: DataFrame,
    requests: DataFrame,
    district: DataFrame,
    road: DataFrame,
    run_date: str | None = None,
) -> DataFrame:
    """The track with road and district names (see ``named_sightings``)."""
    r = _route(named_sightings(flow, requests, district, road), "block_id", "road_label", "district_label")
    return r.select(_run_date(run_date).alias("create_date"), "plate", "blockid", "roadid", "districtid")


def vehicle_track_steps(flow: DataFrame, requests: DataFrame) -> DataFrame:
    """The same route as rows (plate, step number, time, block, road, area): the unpacked form, which
    stays balanced for a vehicle with a huge history (step numbers come from ``number_by_key``)."""
    s = requested_sightings(flow, requests).select("plate", "action_time", *TIE_BREAK)
    n = number_by_key(s, "plate", ["action_time", *TIE_BREAK], F.to_date("action_time"))
    return n.select(
        "plate",
        "step",
        "action_time",
        F.col("block_id").alias("blockid"),
        F.col("road_id").alias("roadid"),
        F.col("area_id").alias("districtid"),
    )
