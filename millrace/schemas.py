"""Record shapes. All are fixed before any data is read, so no job infers a schema.

The topic envelope uses the column names of Spark's Kafka source: a frame read from a
broker and a frame read from a file log are interchangeable.
"""

from pyspark.sql import types as T

LOG_ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

SHARD_ENVELOPE = T.StructType(
    [
        T.StructField("data", T.BinaryType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("sub_sequence_number", T.LongType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("approximate_arrival_timestamp", T.TimestampType()),
        T.StructField("read_time", T.TimestampType()),
        T.StructField("stream_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
    ]
)

LOG_EVENT = T.StructType([T.StructField("id", T.LongType(), False)])

CONSUMED_EVENT = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("shard_id", T.StringType(), False)]
)

USER_ROW = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("user_name", T.StringType())]
)

DAY_EVENT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("id", T.LongType()),
    ]
)

# Payload of the day job, as from_json takes it.
DAY_PAYLOAD = "day string, id bigint"

TOPIC_LINE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("window_start", T.StringType()),
    ]
)

SCHEMA_ID_ROW = T.StructType(
    [T.StructField("my_int", T.LongType()), T.StructField("p_schema_id", T.IntegerType())]
)
