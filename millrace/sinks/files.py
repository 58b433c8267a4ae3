"""Files by destination, from batch and streaming frames alike.

A destination is a combination of partition column values: a topic and window, a day, a
schema id. Spark names the part files itself (without colons) and commits them through a
log, so a directory is to be read back with Spark, not with a raw glob.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVERY_MINUTE = {"processingTime": "60 seconds"}
UNTIL_CAUGHT_UP = {"availableNow": True}


def by_destination(
    df: DataFrame,
    destination: Sequence[str],
    num_shards: int = 1,
    shard_key: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Bring each destination's rows together in at most ``num_shards`` writers, over ``width`` tasks.

    Without a width, ``spark.sql.shuffle.partitions`` holds; a stream that restarts on its checkpoint keeps the number that it
    began with, so a restart at another width has to name it.

    This is a rebalance, not a plain repartition: Spark splits a destination that outgrows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over further tasks, so one that holds
    a third of all rows gets more files instead of one overlong task.
    """
    if num_shards < 1:
        raise ValueError("num_shards must be positive")
    wide = () if width is None else (width,)
    if num_shards == 1:
        return df.hint("rebalance", *wide, *destination)
    spread = F.pmod(F.xxhash64(*(shard_key or df.columns)), F.lit(num_shards))
    return df.withColumn("__shard", spread).hint("rebalance", *wide, *destination, "__shard").drop("__shard")


def in_exact_shards(
    df: DataFrame, destination: str, values: Sequence, num_shards: int, shard_key: Sequence[str] = ()
) -> DataFrame:
    """Exactly ``num_shards`` writers for each known destination value.

    The caller fixes the number of files, and with it how much one task writes. Rows of any
    other destination share one more set of writers.
    """
    index = F.lit(len(values))
    for i, value in enumerate(values):
        index = F.when(F.col(destination) == F.lit(value), i).otherwise(index)
    spread = F.pmod(F.xxhash64(*(shard_key or df.columns)), F.lit(num_shards))
    return df.repartitionById(num_shards * (len(values) + 1), (index * num_shards + spread).cast("int"))


def shares(sizes: Mapping[object, int], total: int, writers: int) -> dict[object, int]:
    """Writers in proportion to sizes, by largest remainder: of ``writers`` for ``total``, those that the sizes come to.

    Equal remainders are served in the order given. Each size gets one writer at least.
    """
    exact = {key: size * writers / total for key, size in sizes.items()}
    given = {key: int(share) for key, share in exact.items()}
    left = round(sum(exact.values())) - sum(given.values())
    for key in sorted(exact, key=lambda k: given[k] - exact[k])[:left]:
        given[key] += 1
    return {key: max(1, n) for key, n in given.items()}


def in_shares(
    df: DataFrame,
    destination: str,
    writers: int,
    num_shards: int = 1,
    shard_key: Sequence[str] = (),
    size: Column | None = None,
) -> DataFrame:
    """Writers for each destination: busy ones in proportion to their size, ``num_shards`` for any other.

    A pass over the data sums ``size`` (by default, rows) by destination. A destination with more than one part
    in ``writers`` of the whole is busy and gets its share of them, so that no task writes much more than such a part, whatever
    the skew; there are fewer busy destinations than writers, and these alone reach the driver. Other destinations are spread
    over ``writers`` tasks, each in ``num_shards`` files. Rows of a destination are dealt by a hash of ``shard_key``, so the
    number of files is exact wherever there are rows for all of them. A null destination is one like any other. Batch frames only.
    """
    if writers < 1 or num_shards < 1:
        raise ValueError("writers and num_shards must be positive")
    sums = df.groupBy(destination).agg(F.sum(F.lit(1) if size is None else size).alias("size"))
    total = sums.agg(F.sum("size")).first()[0] or 0
    busy = sums.where(F.col("size") * writers > total).orderBy(F.desc("size"), destination).collect()
    given = shares({r[destination]: r["size"] for r in busy}, total, writers) if busy else {}
    spread = F.xxhash64(*(shard_key or df.columns))
    # Tasks from 0 on are for busy destinations, one after another; then come those that the others share.
    first = sum(given.values())
    place = F.lit(first) + F.pmod(F.xxhash64(F.lit(1), destination), F.lit(writers)) * num_shards + F.pmod(spread, F.lit(num_shards))
    for key, n in reversed(given.items()):
        first -= n
        place = F.when(F.col(destination).eqNullSafe(F.lit(key)), F.lit(first) + F.pmod(spread, F.lit(n))).otherwise(place)
    return df.repartitionById(sum(given.values()) + writers * num_shards, place.cast("int"))


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
    query_name: str | None = None,
) -> StreamingQuery | None:
    """Write a frame; a streaming one is started in append mode and its query returned.

    The stream's checkpoint holds its progress: started again on the same checkpoint and
    path, it goes on after the last committed batch and repeats none. The default trigger is
    once a minute.
    """
    options = dict(options or {})
    if not df.isStreaming:
        df.write.format(fmt).options(**options).partitionBy(*partition_by).mode(mode).save(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint location")
    writer = (
        df.writeStream.format(fmt)
        .options(**options)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def record_format(spark: SparkSession) -> str:
    """``avro`` where its data source is on the class path, otherwise ``parquet``."""
    try:
        spark.read.format("avro").schema("a int").load([])
    except AnalysisException as problem:
        if "Failed to find data source" in str(problem) or problem.getCondition() == "DATA_SOURCE_NOT_FOUND":
            return "parquet"
        raise
    return "avro"

