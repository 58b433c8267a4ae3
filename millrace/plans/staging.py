"""The test tables as logs.

``events`` is the log: event type is the topic, ``user_id % 2`` the partition or shard,
``event_id`` the offset and the payload's id, ``ts`` the arrival time, ``props`` the value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import keys
from millrace.functions.text import zero_padded
from millrace.functions.times import instant
from millrace.operators import envelope
from millrace.sinks.log import append_log

BATCHES = 4

# What tells the records of a shard log apart: shard, sequence number and arrival.
SHARD_POSITION = ("shard_id", "sequence_number", "approximate_arrival_timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ids(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("id"))


def value_with_nulls() -> Column:
    """``props``, but null for every 97th event, so that empty values occur."""
    return F.when(F.col("event_id") % 97 != 0, F.col("props"))


def topic_log(events: DataFrame, value: Column | None = None, topic: Column | None = None) -> DataFrame:
    return envelope.to_log(
        events,
        topic=F.col("event_type") if topic is None else topic,
        value=value_with_nulls() if value is None else value,
        offset=F.col("event_id"),
        key=keys.long_key(keys.bucket("event_id", 11)),
        partition=keys.bucket("user_id", 2),
        timestamp=instant("ts"),
    )


def day_log(events: DataFrame, day: Column | None = None) -> DataFrame:
    """One topic of JSON values ``{"day": ..., "id": ...}``."""
    day = F.to_date("ts").cast("string") if day is None else day
    value = F.to_json(F.struct(day.alias("day"), F.col("event_id").alias("id")))
    return topic_log(events, value, F.lit("raw"))


def shard_log(events: DataFrame, n_shards: int = 2) -> DataFrame:
    return envelope.to_shards(
        envelope.log_events(events, "event_id"),
        stream_name="events",
        partition_key=F.col("user_id").cast("string"),
        sequence_number=zero_padded("event_id", 20),
        shard_id=keys.shard_name(keys.bucket("user_id", n_shards)),
        arrival=instant("ts"),
    )


def stage(records: DataFrame, path: str, rows: int, by_topic: bool = False, manifest_of: Sequence[str] = ()) -> str:
    """Write a log in enough files for several micro-batches, however small the table is."""
    append_log(records, path, by_topic, max_records_per_file=max(1, math.ceil(rows / BATCHES)), manifest_of=manifest_of)
    return path


def files_per_batch(spark: SparkSession, path: str) -> int:
    """How many files to admit at once for a staged log to take a few micro-batches."""
    n_files = len(spark.read.parquet(path).inputFiles())
    return max(1, math.ceil(n_files / BATCHES))
