"""Operators on random adversarial sightings vs the oracle SQL in DuckDB over the same rows.

Edge cases on purpose: exact time ties and fully duplicated rows, speeds at band edges and <= 0, plates
outside the province map, a registered block with no sightings, duplicate registry rows, unknown and
empty requested plates, dimension ids stored as padded text."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from roadflow.operators import device, inbound, province, ranking, speed, timeops, track
from roadflow.plans import oracle
from roadflow.plans.params import RANGE_HI, RANGE_LO, RUN_DATE, SLICE_RUN_DATE, TOP_N
from test_oracle import _rows

FLOW_SCHEMA = ("create_date date, block_id string, monitor_id string, plate string, action_time timestamp_ntz, "
               "speed int, road_id string, area_id string")


def _data(seed):
    rnd = random.Random(seed)
    plates = [p + chr(65 + i % 3) + f"{i:05d}" for i, p in enumerate("黑黑京沪粤琼辽吉闽黑")]
    base = dt.datetime(1998, 5, 31, 22, 0, 0)
    times = [base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400)) for _ in range(60)]
    rows = []
    for _ in range(500):
        t = rnd.choice(times)  # few distinct times -> many ties
        rows.append((t.date(), f"{rnd.randint(0, 3):04d}", f"{rnd.randint(0, 14):05d}", rnd.choice(plates), t,
                     rnd.choice([-3, 0, 1, 59, 60, 89, 90, 119, 120, 150, rnd.randint(0, 140)]),
                     str(rnd.randint(1, 12)), f"{rnd.randint(0, 9):02d}"))
    rows += rows[:40]  # exact duplicates
    flow = pd.DataFrame(rows, columns=["create_date", "block_id", "monitor_id", "plate", "action_time", "speed", "road_id", "area_id"])
    reg = [(f"{rnd.randint(0, 4):04d}", f"{rnd.randint(0, 16):05d}") for _ in range(40)] + [("0004", "00099")]
    registry = pd.DataFrame(reg + reg[:5], columns=["block_id", "monitor_id"])
    requests = pd.DataFrame({"plate": plates[::3] + ["", "无A00000"]})
    district = pd.DataFrame({"district_id": list(range(0, 7)), "district_name": [f"d{i}" for i in range(7)]})
    road = pd.DataFrame({"road_id": list(range(1, 11)), "road_name": [f"r{i}" for i in range(1, 11)]})
    return flow, registry, requests, district, road


CASES = {
    "device_status": lambda s, f, r, q, d, rd: device.device_status(f, r, RUN_DATE),
    "device_status_daily": lambda s, f, r, q, d, rd: device.device_status_daily(f, r),
    "offline_cameras": lambda s, f, r, q, d, rd: device.offline_cameras(f, r),
    "offline_cameras_daily": lambda s, f, r, q, d, rd: device.offline_cameras_daily(f, r),
    "unregistered_cameras": lambda s, f, r, q, d, rd: device.unregistered_cameras(f, r),
    "block_vehicle_counts": lambda s, f, r, q, d, rd: ranking.block_vehicle_counts(f),
    "block_vehicle_topn": lambda s, f, r, q, d, rd: ranking.block_vehicle_topn(f, TOP_N, RUN_DATE),
    "block_vehicle_topn_packed": lambda s, f, r, q, d, rd: ranking.block_vehicle_topn_packed(f, TOP_N, RUN_DATE),
    "block_speed_bands": lambda s, f, r, q, d, rd: speed.block_speed_bands(f, RUN_DATE),
    "block_speed_web": lambda s, f, r, q, d, rd: speed.speed_web(speed.block_speed_bands(f, RUN_DATE)),
    "inbound_sightings": lambda s, f, r, q, d, rd: inbound.inbound_sightings(f),
    "inbound_first_seen": lambda s, f, r, q, d, rd: inbound.inbound_first_seen(f),
    "inbound_summary": lambda s, f, r, q, d, rd: inbound.inbound_summary(f),
    "vehicle_track": lambda s, f, r, q, d, rd: track.vehicle_track(f, q, RUN_DATE),
    "vehicle_track_named": lambda s, f, r, q, d, rd: track.vehicle_track_named(f, q, d, rd, RUN_DATE),
    "vehicle_track_steps": lambda s, f, r, q, d, rd: track.vehicle_track_steps(f, q),
    "province_counts": lambda s, f, r, q, d, rd: province.province_counts(s, f),
    "flow_by_hour": lambda s, f, r, q, d, rd: timeops.flow_by_hour(f),
    "flow_by_5min": lambda s, f, r, q, d, rd: timeops.flow_by_5min(f),
    "sighting_gap": lambda s, f, r, q, d, rd: timeops.sighting_gap(f),
    "flow_between": lambda s, f, r, q, d, rd: timeops.flow_between(f, RANGE_LO, RANGE_HI),
    "flow_day_slice": lambda s, f, r, q, d, rd: timeops.flow_day_slice(f, SLICE_RUN_DATE),
}


@pytest.fixture(scope="module", params=[1, 2])
def frames(request, spark):
    flow, registry, requests, district, road = _data(request.param)
    con = duckdb.connect()
    for name, pdf in [("flow", flow), ("registry", registry), ("requests", requests), ("district", district), ("road", road)]:
        con.register(name, pdf)
    con.execute(f"create view province as {oracle.VIEWS['province']}")
    sdfs = (
        spark.createDataFrame(flow, FLOW_SCHEMA),
        spark.createDataFrame(registry, "block_id string, monitor_id string"),
        spark.createDataFrame(requests, "plate string"),
        spark.createDataFrame(district, "district_id bigint, district_name string"),
        spark.createDataFrame(road, "road_id bigint, road_name string"),
    )
    return con, sdfs


@pytest.mark.parametrize("name", sorted(CASES))
def test_operator_matches_sql(spark, frames, name):
    con, (f, r, q, d, rd) = frames
    df = CASES[name](spark, f, r, q, d, rd)
    got = df.collect()
    res = con.execute(oracle.BODIES[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())
