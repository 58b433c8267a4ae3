"""Checks on landed records: counts, the exactly-once audit, and multiset comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_and_distinct(df: DataFrame, id_col: str) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_distinct(id_col).alias("distinct_ids"))


def distinct_row_count(df: DataFrame) -> DataFrame:
    return df.distinct().agg(F.count("*").alias("n"))


def rows_per(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def exactly_once(landed: DataFrame, expected: DataFrame, id_col: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Total, distinct, duplicate, missing and unexpected ids, over everything or per group.

    Both sides are counted together in one aggregation by id. Copies of an id are summed
    before the shuffle, so an id that landed a billion times weighs no more than any other.
    """
    keys = [*by, id_col]
    marks = landed.select(*keys, F.lit(1).alias("landed"), F.lit(0).alias("expected")).unionByName(
        expected.select(*keys, F.lit(0).alias("landed"), F.lit(1).alias("expected"))
    )
    per_id = marks.groupBy(*keys).agg(F.sum("landed").alias("landed"), F.sum("expected").alias("expected"))
    was_landed, was_expected = F.col("landed") > 0, F.col("expected") > 0

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    return per_id.groupBy(*by).agg(
        total("landed").alias("total"),
        F.count_if(was_landed).alias("distinct_ids"),
        total(F.when(was_landed, F.col("landed") - 1).otherwise(0)).alias("duplicates"),
        F.count_if(was_expected & ~was_landed).alias("missing"),
        F.count_if(was_landed & ~was_expected).alias("unexpected"),
    )


def multiset_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows in which two frames differ, ignoring order: side, the row, and how many copies.

    Empty when the frames hold the same rows equally often. Copies are reported as a number,
    not repeated, so a row with very many of them stays one row.
    """
    columns = expected.columns
    signed = expected.withColumn("__sign", F.lit(1)).unionByName(actual.select(*columns).withColumn("__sign", F.lit(-1)))
    balance = signed.groupBy(*columns).agg(F.sum("__sign").alias("__sign")).where("__sign <> 0")
    side = F.when(F.col("__sign") > 0, "missing").otherwise("extra")
    return balance.select(side.alias("side"), *columns, F.abs("__sign").alias("copies"))


def assert_same_rows(expected: DataFrame, actual: DataFrame) -> None:
    """Fail, showing a few differing rows, unless both frames hold the same rows."""
    different = multiset_diff(expected, actual).take(10)
    if different:
        raise AssertionError("\n".join(str(row) for row in different))
