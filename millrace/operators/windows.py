"""Fixed windows: aligned to the epoch, start inclusive, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import utc_label


def window_start(df: DataFrame, size: str, time: str | None = None) -> Column:
    """The start of a record's window.

    Without a time column the window is that of processing time, fixed per micro-batch. With
    one, a record whose time is null falls back to processing time instead of being dropped.
    """
    if time is None:
        return F.window(F.current_timestamp(), size).start
    kind = df.schema[time].dataType
    return F.window(F.coalesce(time, F.current_timestamp().cast(kind)), size).start


def with_window(df: DataFrame, size: str, time: str | None = None, out: str = "window_start") -> DataFrame:
    return df.withColumn(out, window_start(df, size, time))


def with_window_label(df: DataFrame, size: str, time: str | None = None, out: str = "window_start") -> DataFrame:
    """The window start as text that is safe in file names; needs an instant, not a zoneless time."""
    return with_window(df, size, time, out).withColumn(out, utc_label(out))


def counts_per_window(df: DataFrame, size: str, time: str, by: list[str]) -> DataFrame:
    """Records per window and group; partial counts are merged, so a busy group is no bottleneck."""
    return df.groupBy(window_start(df, size, time).alias("window_start"), *by).agg(F.count("*").alias("n"))
