"""Topic logs: a broker through Spark's Kafka source, or the same envelope kept in Parquet files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import LOG_ENVELOPE, SHARD_ENVELOPE
from millrace.sources.start import StartPosition


def topic_list(topics: str) -> list[str]:
    """Names from a comma-separated list."""
    names = [name.strip() for name in topics.split(",") if name.strip()]
    if not names:
        raise ValueError("no topic given")
    return names


def kafka_options(
    bootstrap_servers: str,
    topics: str,
    start: StartPosition | None = None,
    consumer_props: Mapping[str, str] | None = None,
    security_props: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options that read one or several topics, committed records only.

    Client settings are passed through under the ``kafka.`` prefix; where consumer and
    security settings name the same property, the security setting holds.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topic_list(topics)),
    }
    options.update((start or StartPosition()).kafka_options())
    for props in (consumer_props, security_props):
        options.update({f"kafka.{name}": str(value) for name, value in (props or {}).items()})
    options["kafka.isolation.level"] = "read_committed"
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """A broker's records in the topic envelope; needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_log(
    spark: SparkSession,
    path: str,
    topics: str | None = None,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Records of a file log in the topic envelope.

    The topic filter reaches the scan; where the log is laid out by topic, other topics'
    folders are not read. The two limits bound what a single micro-batch admits.
    """
    log = _read_files(spark, path, LOG_ENVELOPE, streaming, max_files_per_trigger, max_bytes_per_trigger)
    return log.where(F.col("topic").isin(topic_list(topics))) if topics else log


def read_shards(
    spark: SparkSession,
    path: str | None = None,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    connector: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Records of a sharded stream, with their arrival time and shard.

    Spark ships no connector for such services, so its format name and options are arguments;
    without one the records come from a file log in the shard envelope.
    """
    if connector:
        reader = spark.readStream if streaming else spark.read
        return reader.format(connector).options(**(options or {})).load()
    return _read_files(spark, path, SHARD_ENVELOPE, streaming, max_files_per_trigger, max_bytes_per_trigger)


def _read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    streaming: bool,
    max_files: int | None,
    max_bytes: str | None,
) -> DataFrame:
    if not streaming:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
