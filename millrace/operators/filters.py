"""Row filters ahead of a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_empty(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() | (F.octet_length(value) == 0)


def drop_empty(df: DataFrame, value: str = "value", observe_as: str | None = None) -> DataFrame:
    """Leave out records whose value is null or empty.

    With ``observe_as`` the numbers of records seen and left out are reported as observed
    metrics of that name, per micro-batch in a stream.
    """
    if observe_as:
        df = df.observe(
            observe_as,
            F.count("*").alias("seen"),
            F.count_if(is_empty(value)).alias("dropped"),
        )
    return df.where(~is_empty(value))
