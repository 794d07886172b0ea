"""Physical-plan properties the jobs rely on at scale (checked with explain output)."""

import io
import tempfile
from contextlib import redirect_stdout

import pytest

from roadflow.operators import device, ranking, speed, timeops, track
from roadflow.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored_flow(spark):
    path = tempfile.mkdtemp(prefix="roadflow-stored-flow-") + "/flow"
    # One year is enough for plan checks (fewer partition folders to list).
    one_year = fx.flow(spark, SF).where("create_date between date'1998-01-01' and date'1998-12-31'")
    one_year.hint("rebalance", "create_date").write.partitionBy("create_date").parquet(path)
    return spark.read.parquet(path)


def test_day_slice_prunes_partitions(spark, stored_flow):
    p = plan_of(timeops.flow_day_slice(stored_flow, "1998-06-02"))
    assert "PartitionFilters: [isnotnull(create_date" in p and "1998-06-01" in p


def test_time_range_pushed_to_scan(spark, stored_flow):
    p = plan_of(timeops.flow_between(stored_flow, "1998-01-01 00:00:00", "1998-02-01 00:00:00"))
    assert "PushedFilters: [IsNotNull(action_time), GreaterThan(action_time" in p


def test_scan_reads_only_needed_columns(spark, stored_flow):
    p = plan_of(speed.block_speed_bands(stored_flow, "2024-01-01"))
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "block_id" in read and "speed" in read and "plate" not in read and "road_id" not in read


def test_topn_is_take_ordered(spark, stored_flow):
    assert "TakeOrderedAndProject" in plan_of(ranking.block_vehicle_topn(stored_flow, 5, "2024-01-01"))


def test_partial_aggregation_before_shuffle(spark, stored_flow):
    p = plan_of(speed.block_speed_bands(stored_flow, "2024-01-01"))
    # HashAggregate (partial) -> Exchange -> HashAggregate (final)
    assert p.count("HashAggregate") >= 2 and "Exchange" in p


def test_small_dimensions_broadcast_from_statistics(spark, stored_flow):
    p = plan_of(track.named_sightings(stored_flow, fx.requests(spark, SF), fx.district(spark, SF), fx.road(spark, SF)))
    assert p.count("BroadcastHashJoin") >= 2


def test_no_cross_join_anywhere(spark):
    from roadflow.plans.registry import QUERIES

    for name in sorted(QUERIES):  # every registered query
        p = plan_of(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_status_is_at_camera_grain(spark, stored_flow):
    p = plan_of(device.device_status(stored_flow, fx.registry(spark, SF), "2024-01-01"))
    assert "collect_set" not in p and "ShuffledHashJoin" not in p


def test_flow_join_carries_no_hint(spark):
    assert "strategy" not in fx.flow(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
