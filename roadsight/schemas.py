"""Fixed record schemas (never inferred)."""

from pyspark.sql import types as T

TRAFFIC = T.StructType([
    T.StructField("action_time", T.LongType()),   # epoch milliseconds
    T.StructField("monitor_id", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("area_id", T.StringType()),
])
TRAFFIC_COLUMNS = [f.name for f in TRAFFIC.fields]

MONITOR_LIMIT = T.StructType([
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("speed_limit", T.IntegerType()),
    T.StructField("area_id", T.StringType()),
])

VIOLATION = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("violation", T.StringType()),
    T.StructField("create_time", T.LongType()),
    T.StructField("out_count", T.IntegerType()),
])

POLICE_ACTION = T.StructType([
    T.StructField("police_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("action_status", T.StringType()),
    T.StructField("action_time", T.LongType()),
])

AREA = T.StructType([
    T.StructField("area_id", T.StringType()),
    T.StructField("area_name", T.StringType()),
])

TRACK_COLUMNS = ["car", "action_time", "monitor_id", "road_id", "area_id", "speed"]
