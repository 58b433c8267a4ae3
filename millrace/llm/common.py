"""What several corpus operators share: tables, distributed ranks and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict[tuple[str, str], Any] = {}


def kept(key: tuple[str, str], make: Callable[[], Any]) -> Any:
    """What a worker process keeps from task to task: one thing at a time, so that an operator's tables end with it."""
    if key not in _KEPT:
        give_back()
        _KEPT[key] = make()
        trim()
    return _KEPT[key]


def give_back() -> None:
    """What an operator before this one has kept goes, back to the system where the C library can: workers live on from stage to stage."""
    if _KEPT:
        _KEPT.clear()
        trim()


def trim() -> None:
    """Room that nothing uses any more, in the C library and in Arrow, goes back to the system."""
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)
    pa.default_memory_pool().release_unused()


def trimmed(batches: Iterator[Any]) -> Iterator[Any]:
    """The batches of a task, one held at a time; after the last one its worker, which waits for the next task, is trimmed."""
    try:
        for batch in batches:
            yield batch
            del batch
    finally:
        trim()


def lower_ascii(text: str | None) -> str:
    """A-Z in lower case, every other character as it is; null is empty."""
    return (text or "").translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def ranked(df: DataFrame, group: list[str], bucket: Column, order: list[str], name: str = "rank") -> DataFrame:
    """Adds ``name``, the place from 0 within the group, and ``<name>_of``, the rows of the group.

    Rows are ordered by bucket, then by ``order``. No task sorts a whole group: rows are numbered within a
    bucket and moved up by the counts of the buckets before it. ``df`` is read twice, so pass a written table
    whose group columns are never null.
    """
    df = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket")
    starts = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .withColumn(f"{name}_of", F.sum("_n").over(Window.partitionBy(*group)))
        .drop("_n")
    )
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_within", within).join(starts, keys).withColumn(name, F.col("_start") + F.col("_within")).drop("_bucket", "_start", "_within")


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of the links ``(a, b)``: the smallest id that can be reached.

    Alternating large-star and small-star rounds until the links stay the same. Minima are combined before
    each shuffle, every round is a written table, and nothing but a count and a checksum reaches the driver.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    last = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        stars = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        stars = written(stars, "large", done=[links])
        least = stars.groupBy("a").agg(F.min("b").alias("m"))
        moved = stars.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(moved.unionByName(least.withColumnRenamed("m", "b")).where("a <> b").distinct(), "small", done=[stars])
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    ends = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(ends)
