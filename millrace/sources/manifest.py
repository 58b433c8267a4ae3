"""What the files of a log hold: one small row for each file and partition, kept beside the log.

A manifest lets a consumer start without reading history. Where the log ends is the largest of the ends that the manifest
holds; and a scan leaves out every file that the manifest proves to lie before the start, by a condition on the file's
path, which Spark settles while it lists files.

A file is read once for its row, when the manifest is brought up to date: by the writer after an append, or by the first
consumer that asks. Files that the manifest lacks are never left out, so a manifest that lags costs time and no record.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import path_exists

# Spark does not read folders that begin with an underscore as data.
FOLDER = "_manifest"
PATH = "_metadata.file_path"

#: Paths in one condition. A log of more files leaves out the largest of them, and reads the others to filter their rows.
MOST_PATHS = 20_000


def position(log: DataFrame, offset: str) -> Column:
    """An offset in a form that sorts by its value.

    Sequence numbers of shards are text, of more digits than any number type holds: without
    leading zeros, the longer is the larger, and digits decide between equal lengths. A record
    without an offset has no place in its partition and fails the read.
    """
    known = F.coalesce(F.col(offset), F.raise_error(F.lit(f"a record without {offset}")).cast(log.schema[offset].dataType))
    if not isinstance(log.schema[offset].dataType, T.StringType):
        return known
    digits = F.ltrim(known, F.lit("0"))
    return F.struct(F.length(digits).alias("digits"), digits.alias("value"))


def _statistics(log: DataFrame, keys: Sequence[str], offset: str, timestamp: str) -> DataFrame:
    located = log.select(F.col(PATH).alias("file"), F.col("_metadata.file_size").alias("bytes"), *keys, offset, timestamp)
    return located.groupBy("file", *keys).agg(
        F.max("bytes").alias("bytes"),
        F.count("*").alias("n"),
        F.max(position(log, offset)).alias("last_offset"),
        F.min(timestamp).alias("first_time"),
        F.max(timestamp).alias("last_time"),
    )


def _stored(spark: SparkSession, path: str, shape: T.StructType) -> DataFrame | None:
    """What the manifest holds, each file and partition once, however many writers have added it."""
    if not path_exists(spark, f"{path}/{FOLDER}"):
        return None
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in shape.fields])
    return spark.read.schema(loose).parquet(f"{path}/{FOLDER}")


def _leaving_out(log: DataFrame, files: DataFrame) -> DataFrame:
    """The log without the files named, as far as one condition holds their paths: the largest first."""
    # One row for each file: the paths reach the driver, their number bounded by MOST_PATHS.
    largest = files.groupBy("file").agg(F.max("bytes").alias("bytes")).orderBy(F.desc("bytes"), "file").limit(MOST_PATHS)
    paths = [r["file"] for r in largest.collect()]
    return log.where(~F.col(PATH).isin(paths)) if paths else log


def up_to_date(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    timestamp: str = "timestamp",
) -> DataFrame:
    """The manifest of the log of Parquet files below ``path``, of all its records; only files that it lacks are read."""
    log = spark.read.schema(schema).parquet(path)
    shape = _statistics(log, keys, offset, timestamp).schema
    stored = _stored(spark, path, shape)
    unseen = log if stored is None else _leaving_out(log, stored)
    new = _statistics(unseen, keys, offset, timestamp)
    if stored is not None:
        # Beyond MOST_PATHS, known files are read again; they are not added again.
        new = new.join(stored.select("file").distinct(), "file", "left_anti")
    new.write.mode("append").parquet(f"{path}/{FOLDER}")
    found = _stored(spark, path, shape)
    # Two writers may have added the same file.
    return found.groupBy("file", *keys).agg(*(F.max(c).alias(c) for c in found.columns if c not in ("file", *keys)))


def ends(manifest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last offset of each partition."""
    return manifest.groupBy(*keys).agg(F.max("last_offset").alias("last_offset"))


def without(log: DataFrame, files: DataFrame) -> DataFrame:
    """The (streaming) log without the ``file`` rows given; what is not listed, new files among it, is read."""
    return _leaving_out(log, files)


def before(manifest: DataFrame, start: datetime) -> DataFrame:
    """Files all of whose records are earlier than an instant."""
    last = manifest.groupBy("file").agg(F.max("last_time").alias("last_time"), F.max("bytes").alias("bytes"))
    limit = F.timestamp_micros(F.lit(round(start.timestamp() * 1_000_000)))
    return last.where(F.col("last_time") < limit).select("file", "bytes")
