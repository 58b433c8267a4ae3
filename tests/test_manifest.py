"""Manifests of file logs: what they say, and which files a start leaves unread."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import envelope
from millrace.sinks.files import UNTIL_CAUGHT_UP
from millrace.sinks.log import append_log
from millrace.sources import log, manifest, start

POSITION = ("topic", "partition", "offset", "timestamp")
T0 = 1_700_000_000


def records(spark, first, last, n_files=1):
    ids = spark.range(first, last, 1, n_files)
    return envelope.to_log(
        ids, F.when(F.col("id") % 3 == 0, "a").otherwise("b"), F.col("id").cast("string"), F.col("id"),
        partition=(F.col("id") % 2).cast("int"), timestamp=F.timestamp_seconds(F.lit(T0) + F.col("id")),
    )


def append(spark, path, first, last, n_files=1, **options):
    append_log(records(spark, first, last, n_files), path, **options)


def held(spark, path):
    return manifest.up_to_date(spark, path, schemas.LOG_ENVELOPE)


def files_read(df):
    """How many files of the log a frame opened; what is broadcast to it, as the ends are, does not count."""
    df = df.select("offset")
    df.collect()

    def scans(node):
        name = node.nodeName()
        if name.startswith("Scan"):
            return node.metrics().apply("numFiles").value()
        if name == "AdaptiveSparkPlan":
            return scans(node.executedPlan())
        if name == "ResultQueryStage":
            return scans(node.plan())
        return sum(scans(node.children().apply(k)) for k in range(node.children().size()))

    return scans(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("by_topic", [False, True])
@pytest.mark.parametrize("by_writer", [False, True])
def test_ends_and_counts(spark, tmp_path, rows, by_topic, by_writer):
    path = str(tmp_path / "a log")
    for first, last in ((0, 50), (50, 90)):
        append(spark, path, first, last, 2, by_topic=by_topic, manifest_of=POSITION if by_writer else ())
    found = held(spark, path)
    expected = records(spark, 0, 90)
    assert rows(manifest.ends(found, ["topic", "partition"])) == rows(expected.groupBy("topic", "partition").agg(F.max("offset")))
    assert found.agg(F.sum("n")).first()[0] == 90
    assert log.read_log(spark, path, "a,b", streaming=False).count() == 90


def test_a_file_is_read_once_for_its_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    append(spark, path, 0, 40, 4)
    first = held(spark, path).count()
    seen = []
    real = manifest._leaving_out
    monkeypatch.setattr(manifest, "_leaving_out", lambda log, files: seen.append(real(log, files)) or seen[-1])
    append(spark, path, 40, 60, 2)
    assert held(spark, path).count() > first and files_read(seen[0]) == 2
    assert held(spark, path).agg(F.sum("n")).first()[0] == 60 and seen[1].count() == 0


def test_two_writers_may_add_the_same_files(spark, tmp_path):
    path = str(tmp_path / "log")
    append(spark, path, 0, 40)
    held(spark, path)
    stored = spark.read.parquet(f"{path}/_manifest").collect()
    spark.createDataFrame(stored, spark.read.parquet(f"{path}/_manifest").schema).write.mode("append").parquet(f"{path}/_manifest")
    assert held(spark, path).agg(F.sum("n")).first()[0] == 40


@pytest.mark.parametrize("most", [20_000, 2])
def test_latest_opens_new_files_only(spark, tmp_path, rows, monkeypatch, most):
    """With room for two paths only, the other files are opened and their rows filtered: the same records."""
    monkeypatch.setattr(manifest, "MOST_PATHS", most)
    path, state = str(tmp_path / "log"), str(tmp_path / "state")

    def read():
        found = log.read_log(spark, path, "a", streaming=False)
        return start.apply_start(found, None, start.StartPosition(start.LATEST), state, path=path)

    append(spark, path, 0, 90, 6)
    assert read().count() == 0
    append(spark, path, 90, 120, 2, manifest_of=POSITION)
    assert rows(read(), "offset") == sorted(((k,) for k in range(90, 120, 3)), key=repr)
    assert files_read(read()) == (2 if most > 2 else 6)


def test_timestamps_leave_out_files_that_end_before(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    append(spark, path, 0, 100, 10)
    at = start.StartPosition(start.AT_TIMESTAMP, datetime.fromtimestamp(T0 + 75, timezone.utc))
    found = start.apply_start(log.read_log(spark, path, streaming=False), None, at, str(tmp_path / "state"), path=path)
    assert rows(found, "offset") == [(k,) for k in range(75, 100)] and files_read(found) == 3


def test_streams_leave_them_out_too(spark, tmp_path):
    path, read = str(tmp_path / "log"), []

    def run():
        arriving = start.apply_start(
            log.read_log(spark, path, max_files_per_trigger=100), None, start.StartPosition(start.LATEST), str(tmp_path / "state"), path=path
        )
        query = arriving.writeStream.foreachBatch(lambda b, _: read.extend(r.offset for r in b.collect())).option("checkpointLocation", str(tmp_path / "ck"))
        query = query.trigger(**UNTIL_CAUGHT_UP).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    append(spark, path, 0, 90, 6)
    assert run() == 0 and read == []
    append(spark, path, 90, 100, 2)
    assert run() == 10 and sorted(read) == list(range(90, 100))
