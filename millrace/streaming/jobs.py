"""The landing jobs: source frame, column transformations, file sink.

Each takes a batch or a streaming frame and works the same on both. None aggregates over a
window: windows only decide which files a record lands in. The jobs therefore keep no state
between micro-batches and may be restarted with any number of cores or shuffle partitions.

``save_mode`` is for batch frames: landing on a path that exists is refused unless it says
``append``. Streams always append, and need a checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import keys, text
from millrace.operators import envelope, filters, lookup, windows
from millrace.sinks.files import by_destination, write_files

# Characters of a window's label that name its folder.
FOLDERS = {"day": len("2024-01-31"), "hour": len("2024-01-31T23")}


def _in_folders(rows: DataFrame, window: str, time: str | None, folder: str) -> tuple[DataFrame, str]:
    """``window_start`` for each row, and the column of days or hours that names its folder."""
    if folder not in FOLDERS:
        raise ValueError(f"folder must be one of {tuple(FOLDERS)}, not {folder!r}")
    rows = windows.with_window_label(rows, window, time)
    return rows.withColumn(f"window_{folder}", F.substring("window_start", 1, FOLDERS[folder])), f"window_{folder}"


def _in_order(rows: DataFrame, folders: list[str]) -> DataFrame:
    """Files of a batch landing are sorted by window, so that a reader skips row groups; a stream keeps its order."""
    return rows if rows.isStreaming else rows.sortWithinPartitions(*folders, "window_start")


def land_shards(
    records: DataFrame,
    path: str,
    checkpoint: str | None = None,
    window: str | None = "60 seconds",
    time: str | None = None,
    run_id: str | None = None,
    mode: str = "FAILFAST",
    together: bool = False,
    folder: str = "day",
    trigger: Mapping | None = None,
    save_mode: str = "errorifexists",
    width: int | None = None,
) -> StreamingQuery | None:
    """Decode shard records into Snappy Parquet with their window, one folder per day or hour of windows.

    The window is the column ``window_start``: however short windows are, files number days
    or hours times writers. ``window=None`` writes without windows. With ``together`` a
    folder's rows are brought together first: fewer files for one shuffle, over ``width`` tasks, which
    may be another number each time that the stream is restarted.
    """
    events = envelope.consumed_events(records, mode, keep=(time,) if time else ())
    folders = []
    if run_id:
        events, folders = events.withColumn("run_id", F.lit(run_id)), ["run_id"]
    if window:
        events, name = _in_folders(events, window, time, folder)
        folders = [*folders, name]
    events = events.select("id", "shard_id", *(["window_start"] if window else []), *folders)
    if together and folders:
        events = by_destination(events, folders, width=width)
    if window:
        events = _in_order(events, folders)
    return write_files(
        events, path, "parquet", folders, checkpoint, trigger, save_mode, options={"compression": "snappy"}
    )


def land_topics(
    log: DataFrame,
    path: str,
    checkpoint: str | None = None,
    window: str = "10 seconds",
    time: str | None = None,
    together: bool = True,
    observe_as: str | None = "land_topics",
    fmt: str = "json",
    folder: str = "day",
    trigger: Mapping | None = None,
    save_mode: str = "errorifexists",
) -> StreamingQuery | None:
    """Record values with their window, one folder per topic and day or hour; empty values are left out.

    Each record is one line of JSON, ``value`` and ``window_start``, whatever line breaks the
    value holds; ``fmt="parquet"`` holds the same columns. ``fmt="text"`` writes bare values,
    one folder per topic and window: a value with line breaks is read back as several
    lines, and short windows over many topics make many small files. Rows of a folder are
    brought together by default.
    """
    observe_as = observe_as if log.isStreaming else None
    lines = filters.drop_empty(log, "value", observe_as)
    lines, name = _in_folders(lines, window, time, folder)
    folders = ["topic", "window_start" if fmt == "text" else name]
    lines = lines.select(text.utf8("value").alias("value"), "topic", "window_start", name)
    if together:
        lines = by_destination(lines, folders)
    lines = _in_order(lines, folders)
    if fmt == "text":
        lines = lines.drop(name)
    return write_files(lines, path, fmt, folders, checkpoint, trigger, save_mode)


def land_days(
    log: DataFrame,
    path: str,
    checkpoint: str | None = None,
    together: bool = False,
    trigger: Mapping | None = None,
    save_mode: str = "errorifexists",
) -> StreamingQuery | None:
    """JSON values as Parquet, one folder per day.

    A record without a day lands in the null folder. No shuffle unless ``together`` is set,
    which a backfill over many days wants.
    """
    events = envelope.day_events(log)
    if together:
        events = by_destination(events, ["day"])
    return write_files(events, path, "parquet", ["day"], checkpoint, trigger, save_mode)


def land_by_schema(
    elements: DataFrame,
    registry: DataFrame,
    path: str,
    element: str = "element",
    n_schemas: int = 2,
    num_shards: int = 1,
    fmt: str = "parquet",
    window: str | None = None,
    time: str | None = None,
    folder: str = "day",
    checkpoint: str | None = None,
    trigger: Mapping | None = None,
    save_mode: str = "errorifexists",
) -> StreamingQuery | None:
    """Records of the schema that each element's id points to, one folder per schema id.

    With a window, ``window_start`` is a column and folders are days or hours below the id. An element whose schema is unknown fails the job.
    """
    rows = schema_records(elements, registry, element, n_schemas, keep=(time,) if time else ())
    folders = ["p_schema_id"]
    if window:
        rows, name = _in_folders(rows, window, time, folder)
        folders = [*folders, name]
    rows = rows.select("my_int", *(["window_start"] if window else []), *folders)
    rows = by_destination(rows, folders, num_shards, ["my_int"])
    if window:
        rows = _in_order(rows, folders)
    return write_files(rows, path, fmt, folders, checkpoint, trigger, save_mode)


def schema_records(
    elements: DataFrame, registry: DataFrame, element: str = "element", n_schemas: int = 2, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(my_int, p_schema_id, schema) of each element, its schema looked up by id; elements keep their type."""
    keyed = elements.withColumn("schema_id", keys.bucket(element, n_schemas).cast("int"))
    found = lookup.with_schema(keyed, registry)
    return found.select(
        F.col(element).alias("my_int"), F.col("schema_id").alias("p_schema_id"), "schema", *keep
    )
