"""Generated sequences: the known input of every end-to-end check."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import text


def sequence(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 0 to n - 1."""
    return spark.range(0, n, 1, partitions).select("id")


def paced_sequence(spark: SparkSession, n: int, per_second: int, partitions: int | None = None) -> DataFrame:
    """The same ids as a stream that emits ``per_second`` of them in each one-second batch.

    The source itself never ends; :func:`run_to_end` stops the query once id n - 1 has landed.
    """
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_second)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load().where(F.col("value") < n).select(F.col("value").alias("id"), "timestamp")


def run_to_end(query: StreamingQuery, n: int, timeout: float | None = None) -> None:
    """Stop a query over :func:`paced_sequence` after the batch that holds id n - 1 is committed.

    Waits as long as the query runs, unless a ``timeout`` in seconds is given.
    """
    deadline = time.monotonic() + (float("inf") if timeout is None else timeout)
    try:
        while time.monotonic() < deadline:
            if query.exception() is not None:
                raise query.exception()
            progress = query.lastProgress
            if progress:
                end = json.loads(progress.json)["sources"][0]["endOffset"]
                if end and end["offset"] >= n:
                    return
            time.sleep(0.1)
        raise TimeoutError(f"fewer than {n} ids in {timeout} seconds")
    finally:
        query.stop()


def user_rows(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Rows (id, user_name) for filling a table."""
    return sequence(spark, n, partitions).select("id", text.user_name("id").alias("user_name"))
