"""Lookup of a small table by key, as a broadcast join whose broadcast side is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

MISSING = ("fail", "mark")


def _measured(df: DataFrame, *more) -> dict:
    """Row count and text size of a frame, in one distributed pass."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), *more).first().asDict()


def _fits(measured: dict) -> bool:
    return measured["n"] <= BROADCAST_ROWS and measured["bytes"] <= BROADCAST_BYTES


def small_enough(df: DataFrame) -> bool:
    """Whether a batch frame is proven to be within the broadcast bounds."""
    return _fits(_measured(df))


def with_schema(
    elements: DataFrame,
    registry: DataFrame,
    key: str = "schema_id",
    value: str = "schema",
    on_missing: str = "fail",
) -> DataFrame:
    """Add each element's schema text, found by its schema id.

    A registry within the broadcast bounds is broadcast, so elements are not shuffled and a
    frequent id costs nothing. Beyond them the join is left to Spark, which shuffles and
    splits skewed ids at run time. A registry that lists an id twice is an error. It is read
    once to be measured and again by the join, in a stream by every micro-batch: one that is
    costly to compute should be a written table.

    An id the registry lacks fails the job, or with ``on_missing="mark"`` keeps the element
    with a false ``schema_found``.
    """
    if on_missing not in MISSING:
        raise ValueError(f"on_missing must be one of {MISSING}, not {on_missing!r}")
    registry = registry.select(key, value)
    measured = _measured(registry, F.count(key).alias("ids"), F.count_distinct(key).alias("distinct_ids"))
    if measured["ids"] != measured["distinct_ids"]:
        raise ValueError(f"the registry lists a {key} more than once")
    side = F.broadcast(registry) if _fits(measured) else registry
    joined = elements.join(side, key, "left")
    if on_missing == "mark":
        return joined.withColumn("schema_found", F.col(value).isNotNull())
    unknown = F.raise_error(F.concat(F.lit(f"no schema for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    # On the key as well: a caller that drops the schema text must not lose the check with it.
    return joined.withColumns(
        {
            key: F.when(F.col(value).isNotNull(), F.col(key)).otherwise(unknown.cast(joined.schema[key].dataType)),
            value: F.coalesce(value, unknown),
        }
    )


def map_entries(df: DataFrame, key: str, value: str) -> DataFrame:
    """The entries of a map, one row each, spread by key; lookups use :func:`with_schema`.

    A key that is null or occurs twice fails the job that reads the entries. Copies of a key
    are counted before the shuffle.
    """
    entries = df.groupBy(key).agg(F.count("*").alias("__n"), F.any_value(value).alias(value))
    wrong = F.col(key).isNull() | (F.col("__n") > 1)
    said = F.raise_error(F.concat(F.lit(f"{key} is null or occurs more than once: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    # On both columns: a caller that drops one must not lose the check with it.
    return entries.select(*(F.when(wrong, said.cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in (key, value)))
