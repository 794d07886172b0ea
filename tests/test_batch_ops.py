"""Operator tests on hand-written frames (FIXTURES.md §3; defects D1-D21)."""

from conftest import flow_rows

from roadflow.operators import device, inbound, province, ranking, speed, track

D = "2018-04-26"


def _row(block, cam, plate, t, spd=50, road="1", area="01"):
    return (D, block, cam, plate, f"{D} {t}", spd, road, area)


def test_device_status_block_without_sightings_and_unregistered(spark):
    flow = flow_rows(spark, [_row("0001", "00001", "京A00001", "01:00:00"), _row("0001", "99999", "京A00001", "01:00:01")])
    reg = spark.createDataFrame([("0001", "00001"), ("0001", "00002"), ("0002", "00003")], "block_id string, monitor_id string")
    out = {r.blockid: r for r in device.device_status(flow, reg, D).collect()}
    # Block 0002 had no sightings -> everything offline; D7: 99999 is not counted online.
    assert (out["0001"].monitor_standard_count, out["0001"].normal_monitor_count, out["0001"].abnormal_monitor_count) == (2, 1, 1)
    assert out["0001"].abnormal_monitor_camera_infos == "00002"
    assert (out["0002"].normal_monitor_count, out["0002"].abnormal_monitor_camera_infos) == (0, "00003")
    rogue = device.unregistered_cameras(flow, reg).collect()
    assert [(r.blockid, r.monitor_id, r.sightings) for r in rogue] == [("0001", "99999", 1)]


def test_device_status_all_seen_gives_empty_list(spark):
    flow = flow_rows(spark, [_row("0001", "00001", "京A00001", "01:00:00")])
    reg = spark.createDataFrame([("0001", "00001")], "block_id string, monitor_id string")
    r = device.device_status(flow, reg, D).collect()[0]
    assert (r.abnormal_monitor_count, r.abnormal_monitor_camera_infos) == (0, "")


def test_device_status_daily(spark):
    flow = flow_rows(
        spark,
        [
            ("2018-04-26", "0001", "00001", "京A1", "2018-04-26 01:00:00", 1, "1", "01"),
            ("2018-04-27", "0001", "00002", "京A1", "2018-04-27 01:00:00", 1, "1", "01"),
        ],
    )
    reg = spark.createDataFrame([("0001", "00001"), ("0001", "00002")], "block_id string, monitor_id string")
    out = {str(r.create_date): (r.monitor_standard_count, r.normal_monitor_count, r.abnormal_monitor_count) for r in device.device_status_daily(flow, reg).collect()}
    assert out == {"2018-04-26": (2, 1, 1), "2018-04-27": (2, 1, 1)}


def test_silent_stretches(spark):
    """Per registered camera, the stretches of its block's active days without sightings (the block is not
    active on the 28th)."""
    day = lambda d, c: (f"2018-04-{d}", "0001", c, "京A1", f"2018-04-{d} 01:00:00", 1, "1", "01")
    flow = flow_rows(spark, [day(25, "a"), day(26, "b"), day(27, "a"), day(29, "a"), day(30, "b"), day(30, "x")])
    reg = spark.createDataFrame([("0001", "a"), ("0001", "b"), ("0001", "never"), ("0002", "c")], "block_id string, monitor_id string")
    got = sorted((r.monitor_id, r.silent_from.day, r.silent_to.day, r.silent_days) for r in device.offline_cameras_daily(flow, reg).collect())
    assert got == [("a", 26, 26, 1), ("a", 30, 30, 1), ("b", 25, 25, 1), ("b", 27, 29, 2), ("never", 25, 30, 5)]


def test_chart_counts_in_named_columns(spark):
    flow = flow_rows(spark, [_row("0001", "00001", "京A1", "01:00:00")])
    reg = spark.createDataFrame([("0001", "00001"), ("0001", "00002"), ("0002", "00003")], "block_id string, monitor_id string")
    chart = device.device_chart(device.device_status(flow, reg, D)).collect()[0]
    assert (chart.blockid, chart.brokenCount, chart.monitorSum) == ("0001|0002", "1|1", "2|1")  # D8


def test_vehicle_counted_in_each_block_and_numeric_topn(spark):
    rows = [_row("0001", "00001", "京A1", "01:00:00"), _row("0002", "00002", "京A1", "01:00:00")]
    # block 0003: 12 vehicles, block 0004: 9 vehicles -> numeric order puts 12 first (D2; "9" > "12" as text)
    rows += [_row("0003", "00003", f"京B{i}", "02:00:00") for i in range(12)]
    rows += [_row("0004", "00004", f"京C{i}", "02:00:00") for i in range(9)]
    flow = flow_rows(spark, rows)
    counts = {r.blockid: r.auto_count for r in ranking.block_vehicle_counts(flow).collect()}
    assert counts["0001"] == 1 and counts["0002"] == 1  # D1
    top = [(r.blockid, r.auto_count) for r in ranking.block_vehicle_topn(flow, 3, D).collect()]
    assert top == [("0003", 12), ("0004", 9), ("0001", 1)]  # D3: n honoured, tie by block id
    packed = ranking.block_vehicle_topn_packed(flow, 3, D).collect()[0]
    assert (packed.blockid, packed.auto_count) == ("0003|0004|0001", "12|9|1")


def test_speed_bands_edges_and_mean(spark):
    speeds = [-1, 0, 1, 59, 60, 89, 90, 119, 120]
    flow = flow_rows(spark, [_row("0001", "00001", "京A1", "01:00:00", s) for s in speeds] + [_row("0002", "00001", "京A1", "01:00:00", 200)])
    out = speed.block_speed_bands(flow, D).collect()
    assert [r.blockid for r in out] == ["0002", "0001"]  # D4: numeric mean order
    r = out[1]
    assert (r.min_Speed, r.normal_Speed, r.med_Speed, r.high_Speed) == (2, 2, 2, 1)  # D5
    assert r.avg_Speed == round(sum(speeds) / 9, 3)


def test_province_counts_other_row(spark):
    flow = flow_rows(spark, [_row("0001", "00001", "粤A00013", "01:00:00"), _row("0001", "00001", "京A00001", "01:00:00")])
    out = [(r.province, r.sightings) for r in province.province_counts(spark, flow).collect()]
    assert out[0] == ("黑龙江", 0) and ("北京", 1) in out and out[-1] == ("other", 1) and len(out) == 8  # D12


def test_inbound_first_seen_and_order(spark):
    """First sighting per non-local vehicle with road and area both kept (D14), sightings in time order."""
    flow = flow_rows(
        spark,
        [
            _row("0002", "00002", "京A1", "02:00:00"),
            _row("0001", "00001", "京A1", "01:00:00", road="7", area="03"),
            _row("0001", "00001", "黑A1", "00:00:00"),
        ],
    )
    firsts = inbound.inbound_first_seen(flow).collect()
    assert [(r.plate, r.first_inbound_position, r.roadid, r.areaid, r.sightings) for r in firsts] == [("京A1", "0001", "7", "03", 2)]
    seq = [r.first_inbound_position for r in inbound.inbound_sightings(flow).collect()]
    assert seq == ["0001", "0002"]


def test_track_names_numeric_ids_and_ties(spark):
    flow = flow_rows(
        spark,
        [
            _row("0002", "00002", "京A1", "01:00:00", road="2", area="07"),
            _row("0001", "00001", "京A1", "01:00:00", road="9", area="05"),  # same time: tie-break by block
            _row("0003", "00003", "京A1", "00:30:00", road="1", area="07"),
            _row("0004", "00003", "京B2", "00:30:00"),
        ],
    )
    req = spark.createDataFrame([("京A1",), ("",)], "plate string")
    district = spark.createDataFrame([(7, "Seven")], "district_id int, district_name string")
    road = spark.createDataFrame([(1, "One"), (2, "Two")], "road_id bigint, road_name string")
    t = track.vehicle_track(flow, req, D).collect()
    assert len(t) == 1 and t[0].blockid == "0003>0001>0002" and t[0].roadid == "1>9>2"  # D19
    n = track.vehicle_track_named(flow, req, district, road, D).collect()[0]
    assert n.districtid == "Seven>05>Seven"  # D18 ('07' = 7) and D17 (unknown id kept)
    assert n.roadid == "One>9>Two"


def test_speed_rank_orders_by_mean_desc(spark):
    from roadflow.streaming import live

    df = spark.createDataFrame(
        [("2018-04-26 10:00:00", "2018-04-26 10:20:00", "0001", 9), ("2018-04-26 10:00:00", "2018-04-26 10:20:00", "0002", 70),
         ("2018-04-26 10:00:00", "2018-04-26 10:20:00", "0003", 70)],
        "window_start string, window_end string, blockid string, avg_speed bigint",
    )
    r = live.speed_rank(df).collect()[0]
    assert (r.blockRank, r.speedRank) == ("0002|0003|0001", "70|70|9")  # D13: ranked, ties by block
