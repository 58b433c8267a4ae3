"""What passes through a stream, per topic and partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def per_partition(log: DataFrame) -> DataFrame:
    """Records, null keys and null values of each topic partition, over a batch frame."""
    return log.groupBy("topic", "partition").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("key").isNull()).alias("null_keys"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
    )


def record(log: DataFrame, path: str, checkpoint: str, trigger: Mapping) -> StreamingQuery:
    """Store :func:`per_partition` of each micro-batch, one folder per batch id.

    A batch that is repeated after a crash replaces its own folder, so :func:`recorded` is
    exact over any number of batches and restarts.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        per_partition(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return log.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`record` stored, summed over the batches."""
    stored = spark.read.schema("topic string, partition int, n bigint, null_keys bigint, null_values bigint").parquet(path)
    sums = (F.sum(name).alias(name) for name in ("n", "null_keys", "null_values"))
    return stored.groupBy("topic", "partition").agg(*sums)


def tap(log: DataFrame, topics: Sequence[str] = (), name: str = "tap") -> DataFrame:
    """Pass records on unchanged and report metrics of each micro-batch under ``name``.

    Each topic named adds its own record count. For watching a live query: read them from
    ``query.recentProgress[i]["observedMetrics"]``, which forgets old batches. Use
    :func:`record` where every batch must count.
    """
    per_topic = [F.count_if(F.col("topic") == topic).alias(f"n_{topic}") for topic in topics]
    return log.observe(
        name,
        F.count("*").alias("n"),
        F.count_if(F.col("key").isNull()).alias("null_keys"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
        *per_topic,
    )
