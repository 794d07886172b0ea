import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from roadflow.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="roadflow-tests")
    yield s


def flow_rows(spark, rows):
    """rows: (create_date, block, camera, plate, 'yyyy-MM-dd HH:mm:ss', speed, road, area)"""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        rows,
        "create_date string, block_id string, monitor_id string, plate string, action_time string, speed int, road_id string, area_id string",
    )
    return df.select(
        F.col("create_date").cast("date").alias("create_date"),
        "block_id",
        "monitor_id",
        "plate",
        F.col("action_time").cast("timestamp_ntz").alias("action_time"),
        "speed",
        "road_id",
        "area_id",
    )
