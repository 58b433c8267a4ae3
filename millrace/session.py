"""Session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for written intermediates, on the storage the cluster shares.

    The base is ``spark.checkpoint.dir`` (or the checkpoint directory already set). A
    machine-local temporary folder is used only when the master itself is local, since
    executors on other machines could not read it back.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Folders that `written` has stored and nothing has deleted yet, by application.
_stored: dict[str, list[str]] = {}
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, name: str, done: Iterable[DataFrame] = ()) -> DataFrame:
    """The frame as a table in scratch space: computed once, and safe from lost executors.

    ``done`` names tables that this one was made from and that nothing else will read: they are deleted.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    _folders[stored] = path
    for frame in done:
        _delete(spark, _folders.get(frame))
    return stored


def delete_written(spark: SparkSession, but_for: DataFrame | None = None) -> None:
    """Delete all tables that :func:`written` has stored in this application, but for those that ``but_for`` reads.

    For callers that have stored the results themselves: any other frame that still reads one of the tables is broken by it.
    """
    read = set() if but_for is None else {_bare(f) for f in but_for.inputFiles()}
    for path in list(_stored.get(spark.sparkContext.applicationId, [])):
        if not any(f.startswith(_bare(path) + "/") for f in read):
            _delete(spark, path)


def _bare(path: str) -> str:
    """A path without its scheme."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def _delete(spark: SparkSession, path: str | None) -> None:
    stored = _stored.get(spark.sparkContext.applicationId, [])
    if path in stored:
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
        stored.remove(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system its URI names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)
