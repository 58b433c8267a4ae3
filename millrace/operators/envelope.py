"""Records into and out of their envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import codec, keys, text
from millrace.schemas import DAY_PAYLOAD


def produced_records(ids: DataFrame, topic: str, key_buckets: int = 11, id_col: str = "id") -> DataFrame:
    """(topic, key, value) of a topic producer: an eight-byte key and a JSON value per id."""
    return ids.select(
        F.lit(topic).alias("topic"),
        keys.long_key(keys.bucket(id_col, key_buckets)).alias("key"),
        text.id_json(id_col).cast("binary").alias("value"),
    )


def to_log(
    df: DataFrame,
    topic: Column,
    value: Column,
    offset: Column,
    key: Column | None = None,
    partition: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """The topic envelope; the record time defaults to processing time."""
    return df.select(
        (F.lit(None) if key is None else key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic.cast("string").alias("topic"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def log_events(ids: DataFrame, id_col: str = "id", out: str = "data") -> DataFrame:
    """Each id as the binary body of a log event, other columns kept."""
    return codec.encode_long(ids, id_col, out)


def to_shards(
    df: DataFrame,
    stream_name: str,
    data: str = "data",
    partition_key: Column | None = None,
    *,
    sequence_number: Column,
    shard_id: Column | None = None,
    n_shards: int = 1,
    arrival: Column | None = None,
) -> DataFrame:
    """The shard envelope around payloads.

    By default the partition key is random and decides the shard. The key is evaluated once,
    so the shard always belongs to the key that is written beside it. A start position tells
    records apart by their sequence numbers, so there is no default for them.
    """
    key = keys.partition_key() if partition_key is None else partition_key
    keyed = df.withColumn("__key", key)
    shard = keys.shard_name(keys.shard_index("__key", n_shards)) if shard_id is None else shard_id
    return keyed.select(
        F.col(data).alias("data"),
        sequence_number.cast("string").alias("sequence_number"),
        F.lit(0).cast("bigint").alias("sub_sequence_number"),
        F.col("__key").cast("string").alias("partition_key"),
        (F.current_timestamp() if arrival is None else arrival).alias("approximate_arrival_timestamp"),
        F.current_timestamp().alias("read_time"),
        F.lit(stream_name).alias("stream_name"),
        shard.cast("string").alias("shard_id"),
    )


def payloads(records: DataFrame) -> DataFrame:
    """The payload alone."""
    return records.select("data")


def consumed_events(records: DataFrame, mode: str = "FAILFAST", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, shard_id) decoded from shard records, with any envelope columns to keep."""
    return codec.decode_long(records.select("data", "shard_id", *keep), "data", "id", mode).select(
        "id", "shard_id", *keep
    )


def day_events(log: DataFrame) -> DataFrame:
    """(key, day, id) from topic records whose values are JSON."""
    payload = text.from_json_text(text.utf8("value"), DAY_PAYLOAD)
    fields = {name: payload.getField(name) for name in ("day", "id")}
    return log.select(text.utf8("key").alias("key"), *(field.alias(name) for name, field in fields.items()))
