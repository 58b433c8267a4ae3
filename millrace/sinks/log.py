"""Topic and shard logs as sinks: a broker, or files in the same envelope."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.files import EVERY_MINUTE, write_files
from millrace.sources import manifest


def kafka_write_options(
    bootstrap_servers: str, topic: str | None = None, producer_props: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of a topic writer; without a topic, each record's ``topic`` column decides."""
    options = {"kafka.bootstrap.servers": bootstrap_servers}
    options.update({f"kafka.{name}": str(value) for name, value in (producer_props or {}).items()})
    if topic:
        options["topic"] = topic
    return options


def write_kafka(
    records: DataFrame,
    options: Mapping[str, str],
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery | None:
    """Send (topic, key, value) records; a send that fails fails its task, and is retried."""
    columns = [c for c in ("topic", "key", "value") if c in records.columns and not (c == "topic" and "topic" in options)]
    records = records.select(*columns)
    if not records.isStreaming:
        records.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint location")
    writer = records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_MINUTE)).start()


def append_log(
    records: DataFrame,
    path: str,
    by_topic: bool = False,
    max_records_per_file: int | None = None,
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    manifest_of: Sequence[str] = (),
) -> StreamingQuery | None:
    """Append enveloped records to a file log, laid out by topic when readers pick topics.

    ``manifest_of`` names the key, offset and time columns (the last two last) by which a batch append brings the log's
    manifest up to date: the new files are read once, and consumers need not.
    """
    options = {"maxRecordsPerFile": str(max_records_per_file)} if max_records_per_file else {}
    query = write_files(
        records,
        path,
        "parquet",
        partition_by=("topic",) if by_topic else (),
        checkpoint=checkpoint,
        trigger=trigger,
        mode="append",
        options=options,
    )
    if query is None and manifest_of:
        *keys, offset, timestamp = manifest_of
        manifest.up_to_date(records.sparkSession, path, records.schema, keys, offset, timestamp)
    return query
