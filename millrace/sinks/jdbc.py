"""Database tables as sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_options(
    connection: Mapping[str, str], truncate: bool = True, num_partitions: int = 4, batchsize: int = 10_000
) -> dict[str, str]:
    """Options of an overwrite that empties the table but keeps its definition.

    ``num_partitions`` bounds the connections open at once, so set it to what the database
    bears. ``truncate=False`` lets the table be dropped and made anew.
    """
    return dict(connection) | {
        "truncate": str(truncate).lower(),
        "numPartitions": str(num_partitions),
        "batchsize": str(batchsize),
    }


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite") -> None:
    """Each task commits on its own, so a retried task may insert its rows again: give the
    table a key, or audit it afterwards."""
    df.write.format("jdbc").options(**options).mode(mode).save()
