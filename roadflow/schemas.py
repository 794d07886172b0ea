"""Typed schemas of the inputs. The reference keeps every field as text; here they are typed
once at ingest, so later jobs compare numbers as numbers and times as times."""

from pyspark.sql import types as T

# One camera sighting (S1). action_time is camera wall-clock time, so it carries no zone (TIMESTAMP_NTZ).
FLOW = T.StructType(
    [
        T.StructField("create_date", T.DateType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("monitor_id", T.StringType()),
        T.StructField("plate", T.StringType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("speed", T.IntegerType()),
        T.StructField("road_id", T.StringType()),
        T.StructField("area_id", T.StringType()),
    ]
)

FLOW_COLUMNS = [f.name for f in FLOW.fields]

# Tie-break after action_time wherever an order must be the same on every run (O4, G11, G13, R3; D19).
# It is the sighting's own columns, so two rows that tie on all of them are identical in every output.
TIE_BREAK = ["block_id", "monitor_id", "road_id", "area_id", "speed"]
