"""One value per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def combine_per_key(
    df: DataFrame, key: str, value: str, how: Callable[[Column], Column] = F.min, out: str | None = None
) -> DataFrame:
    """Combine each key's values with a Spark aggregate (``F.min``, ``F.sum``, ``F.bit_or``, ...)."""
    return df.groupBy(key).agg(how(F.col(value)).alias(out or value))


def combine_per_key_with(
    df: DataFrame, key: str, value: str, merge: Callable[[Column, Column], Column], width: int = 10_000
) -> DataFrame:
    """Combine each key's values with any associative, commutative function of two columns.

    For functions that no Spark aggregate expresses. Null values are left out; a key without
    others has a null. Values meet in groups of about ``width``, then what the groups gave,
    and so on, so no task ever holds all values of a key. Rows are numbered as they are
    written, so that a repeated task deals them out alike.
    """
    if width < 2:
        raise ValueError("width must be 2 or more")
    rows = written(df.select(key, value, F.monotonically_increasing_id().alias("__spread")), "combine")
    most = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 1
    kind = df.schema[value].dataType
    while True:
        most = -(-most // width)
        held = F.collect_list(value)
        rest = F.slice(held, F.lit(2), F.greatest(F.size(held) - 1, F.lit(0)))
        merged = F.reduce(rest, F.get(held, F.lit(0)), lambda a, b: merge(a, b).cast(kind))
        spread = F.pmod(F.xxhash64("__spread"), F.lit(most))
        rows = rows.groupBy(key, spread.alias("__spread")).agg(merged.alias(value))
        if most == 1:
            return rows.select(key, value)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
