"""Records in the shape of the schema that each element's id points to, from batch and streaming frames.

The registry is read anew for each batch. What a batch uses of it, one row for each id in use, is stored under the
batch's number before any record is written: a batch that is repeated after a crash has the schemas it had before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.record_schema import record_type, shaped
from millrace.operators import lookup
from millrace.session import path_exists, written
from millrace.sinks.files import EVERY_MINUTE, by_destination, record_format

Registry = Callable[[SparkSession], DataFrame]

# The folder of a schema id, and below it, in streams, of a batch.
FOLDER, BATCH = "p_schema_id", "batch_id"


def schemas_in_use(elements: DataFrame, registry: DataFrame, key: str = "schema_id", schema: str = "schema") -> DataFrame:
    """(key, schema) for each id that elements have. Unknown ids, and ids that the registry repeats, are errors."""
    return lookup.with_schema(elements.select(key).distinct(), registry, key, schema).select(key, schema)


def snapshot(
    elements: DataFrame, registry: Registry, path: str, key: str = "schema_id", schema: str = "schema"
) -> DataFrame:
    """:func:`schemas_in_use` as first stored at ``path``; the registry is not read again when it is there."""
    spark = elements.sparkSession
    shape = T.StructType([elements.schema[key], T.StructField(schema, T.StringType())])
    if not path_exists(spark, f"{path}/_SUCCESS"):
        schemas_in_use(elements, registry(spark), key, schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(shape).parquet(path)


def for_each_batch(
    elements: DataFrame,
    registry: Registry,
    checkpoint: str,
    land: Callable[[DataFrame, DataFrame, int], None],
    key: str = "schema_id",
    schema: str = "schema",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Run ``land(batch, schemas in use, batch id)`` on each micro-batch of a stream.

    The registry may grow while the stream runs: the batch that first holds a new id looks it up. It is measured, and
    checked for repeated ids, by every batch. ``land`` must replace what an earlier run of the same batch id has left.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            used = snapshot(batch, registry, f"{checkpoint}/registry/{BATCH}={batch_id}", key, schema)
            land(batch, used, batch_id)
        finally:
            batch.unpersist()

    writer = elements.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_MINUTE)).start()


def _write_each(
    elements: DataFrame,
    used: DataFrame,
    path: str,
    key: str,
    schema: str,
    sources: Mapping[str, str] | None,
    fmt: str,
    num_shards: int,
    batch_id: int | None,
) -> None:
    """One write for each schema text in use: its own projection, and a folder for each of its ids."""
    texts = sorted(r[schema] for r in used.select(schema).distinct().collect())
    # All projections are made before the first record is written: a schema that cannot be filled leaves nothing behind.
    records = {text: record_type(text) for text in texts}
    columns = {text: shaped(elements.schema, record, sources) for text, record in records.items()}
    for text, record in records.items():
        if taken := {FOLDER, BATCH} & set(record.names):
            raise ValueError(f"fields must not be called {sorted(taken)}, as folders are")
    for text in texts:
        ids = used.where(F.col(schema) == text).select(key)
        ids = F.broadcast(ids) if lookup.small_enough(ids) else ids
        rows = elements.join(ids, key, "left_semi").select(*columns[text], F.col(key).alias(FOLDER))
        folders = [FOLDER]
        if batch_id is not None:
            rows, folders = rows.withColumn(BATCH, F.lit(batch_id)), [FOLDER, BATCH]
        rows = by_destination(rows, folders, num_shards, records[text].names)
        options = {"avroSchema": text} if fmt == "avro" else {}
        writer = rows.write.format(fmt).options(**options).partitionBy(*folders)
        if batch_id is None:
            writer.mode("append").save(path)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def land_records(
    elements: DataFrame,
    registry: DataFrame | Registry,
    path: str,
    key: str = "schema_id",
    schema: str = "schema",
    sources: Mapping[str, str] | None = None,
    num_shards: int = 1,
    fmt: str | None = None,
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    save_mode: str = "errorifexists",
) -> StreamingQuery | None:
    """Land elements as records of their schemas, each with the fields of its own schema, one folder per schema id.

    Fields are filled from the columns of the elements (see :func:`millrace.functions.record_schema.shaped`). An
    element is written by one job for each schema text in use, so ids that share a text share a job; elements
    that are costly to compute should be a written table (a stream keeps each batch for that time). Files are Avro where
    the data source is present, otherwise Parquet. An id that the registry lacks or repeats fails the job before anything is written.

    A stream reads the registry anew for each batch, so pass a function that lists its files when it is called. Its files
    lie one folder deeper, by batch id, and a repeated batch replaces its own.
    """
    look_up = registry if callable(registry) else lambda spark: registry
    fmt = fmt or record_format(elements.sparkSession)

    def land(batch: DataFrame, used: DataFrame, batch_id: int | None = None) -> None:
        _write_each(batch, used, path, key, schema, sources, fmt, num_shards, batch_id)

    if elements.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming write needs a checkpoint location")
        return for_each_batch(elements, look_up, checkpoint, land, key, schema, trigger)
    if save_mode not in ("errorifexists", "append"):
        raise ValueError(f"save_mode must be errorifexists or append, not {save_mode!r}")
    if save_mode == "errorifexists" and path_exists(elements.sparkSession, path):
        raise FileExistsError(path)
    land(elements, written(schemas_in_use(elements, look_up(elements.sparkSession), key, schema), "schemas-in-use"))
    return None


def read_records(spark: SparkSession, path: str, schema_id: object, schema: str, fmt: str | None = None) -> DataFrame:
    """The records landed under one schema id, with the fields of its schema."""
    record = record_type(schema)
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in record.fields])
    reader = spark.read.format(fmt or record_format(spark)).schema(loose)
    return reader.load(f"{path}/{FOLDER}={schema_id}").select(*(f"`{name}`" for name in record.names))
