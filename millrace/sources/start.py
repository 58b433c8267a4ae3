"""Where a consumer starts in a log.

``TRIM_HORIZON`` reads everything, ``AT_TIMESTAMP`` reads records that arrived at or after
an instant, and ``LATEST`` reads records after the last one that exists, per partition,
when the consumer first starts. A restarted consumer keeps the start it first resolved.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.lookup import small_enough
from millrace.session import path_exists
from millrace.sources import manifest
from millrace.sources.manifest import position

# The start modes.
LATEST = "LATEST"
TRIM_HORIZON = "TRIM_HORIZON"
AT_TIMESTAMP = "AT_TIMESTAMP"
MODES = (LATEST, TRIM_HORIZON, AT_TIMESTAMP)


@dataclass(frozen=True)
class StartPosition:
    mode: str = LATEST
    start_ts: datetime | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"start mode must be one of {MODES}, not {self.mode!r}")
        if (self.mode == AT_TIMESTAMP) != (self.start_ts is not None):
            raise ValueError(f"a start timestamp goes with {AT_TIMESTAMP}, and only with it")

    @classmethod
    def parse(cls, mode: str = LATEST, start_ts: str | None = None) -> StartPosition:
        """From configuration text; the timestamp looks like ``2024-02-01T06:00:00.00Z``."""
        if start_ts is None:
            return cls(mode)
        when = datetime.fromisoformat(start_ts)
        return cls(mode, when if when.tzinfo else when.replace(tzinfo=timezone.utc))

    def kafka_options(self) -> dict[str, str]:
        """The same start for Spark's Kafka source, which itself ignores it on restart."""
        if self.mode == AT_TIMESTAMP:
            millis = round(self.start_ts.timestamp() * 1000)
            return {"startingTimestamp": str(millis), "startingOffsetsByTimestampStrategy": "latest"}
        return {"startingOffsets": "latest" if self.mode == LATEST else "earliest"}


def _literal(micros: int, kind: T.DataType) -> Column:
    """An instant in the type of the column it is compared with, so that the scan takes the comparison.

    A zoneless column holds UTC wall-clock times.
    """
    if not isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(F.lit(micros))
    wall_clock = datetime(1970, 1, 1) + timedelta(microseconds=micros)
    return F.expr(f"timestamp_ntz'{wall_clock.isoformat(' ')}'")


def last_offsets(log: DataFrame, keys: list[str], offset: str = "offset") -> DataFrame:
    """The last offset of each log partition: one small row per partition."""
    return log.groupBy(*keys).agg(F.max(position(log, offset)).alias("last_offset"))


def after(log: DataFrame, ends: DataFrame, keys: list[str], offset: str = "offset") -> DataFrame:
    """Records strictly after the given ends; partitions without one are read from their start."""
    ends = F.broadcast(ends) if small_enough(ends) else ends
    return (
        log.join(ends, keys, "left")
        .where((position(log, offset) > F.col("last_offset")) | F.col("last_offset").isNull())
        .select(*log.columns)
    )


def apply_start(
    log: DataFrame,
    existing: DataFrame | None,
    start: StartPosition,
    state_path: str,
    keys: tuple[str, ...] = ("topic", "partition"),
    offset: str = "offset",
    timestamp: str = "timestamp",
    path: str | None = None,
) -> DataFrame:
    """Restrict a (streaming) log to its start position.

    ``existing`` is the log as a batch frame. The position is resolved once and written under
    ``state_path``, a folder in or beside the checkpoint; when that holds a position already,
    the given one is ignored.

    ``path`` names the folder of a file log, whose manifest (see :mod:`millrace.sources.manifest`) then says where
    the log ends, and which files lie wholly before the start: these are not read at all, neither now nor by the stream.
    The log must come straight from the files, filtered at most; ``existing`` is not read then.
    """
    spark = log.sparkSession
    mode, start_micros = _resolve_once(spark, existing, log.schema, start, state_path, list(keys), offset, timestamp, path)
    if mode == TRIM_HORIZON:
        return log
    if path is not None:
        log = manifest.without(log, spark.read.schema("file string, bytes bigint").parquet(f"{state_path}/passed"))
    if mode == AT_TIMESTAMP:
        return log.where(F.col(timestamp) >= _literal(start_micros, log.schema[timestamp].dataType))
    ends = spark.read.schema(last_offsets(log, list(keys), offset).schema).parquet(f"{state_path}/ends")
    return after(log, ends, list(keys), offset)


def _resolve_once(
    spark: SparkSession,
    existing: DataFrame | None,
    shape: T.StructType,
    start: StartPosition,
    state: str,
    keys: list[str],
    offset: str,
    timestamp: str,
    path: str | None,
) -> tuple[str, int | None]:
    schema = "mode string, start_micros bigint"
    if not path_exists(spark, f"{state}/position/_SUCCESS"):
        # The position is written last: if this is cut short, the next run resolves again.
        held = None
        if path is not None and start.mode != TRIM_HORIZON:
            held = manifest.up_to_date(spark, path, shape, keys, offset, timestamp)
            # All files of the manifest lie before its ends.
            passed = held if start.mode == LATEST else manifest.before(held, start.start_ts)
            passed.select("file", "bytes").distinct().write.mode("overwrite").parquet(f"{state}/passed")
        if start.mode == LATEST:
            ends = last_offsets(existing, keys, offset) if held is None else manifest.ends(held, keys)
            ends.write.mode("overwrite").parquet(f"{state}/ends")
        micros = round(start.start_ts.timestamp() * 1_000_000) if start.start_ts else None
        row = spark.createDataFrame([(start.mode, micros)], schema)
        row.write.mode("overwrite").parquet(f"{state}/position")
    stored = spark.read.schema(schema).parquet(f"{state}/position").first()
    return stored["mode"], stored["start_micros"]
