"""Files that jobs landed, and keyed text lines. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet files, every column nullable: files are not bound by what a record type promises."""
    if isinstance(schema, T.StructType):
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text_lines(spark: SparkSession, path: str, schema: T.StructType | str = "value string") -> DataFrame:
    return spark.read.schema(schema).text(path)


def keyed_lines(lines: DataFrame, delimiter: str = ":") -> DataFrame:
    """Lines ``key<delimiter>value`` as binary key and value, cut at the first delimiter.

    A line without a delimiter is a value with a null key.
    """
    line = F.col("value")
    at = F.instr(line, F.lit(delimiter))
    key = F.when(at > 0, F.substring_index(line, delimiter, 1))
    value = F.when(at > 0, F.substring(line, at + len(delimiter), F.length(line))).otherwise(line)
    return lines.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))
