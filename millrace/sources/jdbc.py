"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Public driver class names.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"


def mysql_url(host: str, port: int, database: str) -> str:
    """With multi-row inserts, without which each row of a batch is its own statement."""
    return f"jdbc:mysql://{host}:{port}/{database}?rewriteBatchedStatements=true"


def sqlserver_url(host: str, port: int, database: str) -> str:
    return f"jdbc:sqlserver://{host}:{port};databaseName={database};"


def connection_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    given = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}
    return {name: value for name, value in given.items() if value is not None} | dict(extra or {})


def read_options(
    connection: Mapping[str, str],
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
) -> dict[str, str]:
    """Options of a read that is split over tasks by ranges of a column.

    The bounds place the cuts and filter nothing: the outer ranges are open. Without a
    partition column one task reads the whole table, so give one for any large table.
    """
    options = dict(connection) | {"fetchsize": str(fetchsize)}
    split = (partition_column, lower, upper, num_partitions)
    if all(part is None for part in split):
        return options
    if any(part is None for part in split):
        raise ValueError("a split read needs partition_column, lower, upper and num_partitions")
    names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    return options | {name: str(part) for name, part in zip(names, split)}


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
