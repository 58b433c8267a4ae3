import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import envelope
from millrace.sinks import files as sink
from millrace.sinks import jdbc, log
from millrace.sources import files, generate
from millrace.streaming import jobs


def part_files(path):
    """Data files per folder below a path."""
    found = {}
    for folder, _, names in os.walk(path):
        parts = [n for n in names if n.startswith("part-")]
        if parts:
            found[os.path.relpath(folder, path)] = parts
    return found


def registry(spark):
    of = '{"type": "record", "name": "%s", "fields": [{"name": "my_int", "type": "%s"}]}'
    return spark.createDataFrame([(0, of % ("Even", "long")), (1, of % ("Odd", "int"))], "schema_id int, schema string")


@pytest.mark.parametrize("window", [None, "2 minutes"])
def test_one_file_per_schema_id_with_and_without_windows(spark, tmp_path, rows, window):
    path = str(tmp_path / "landed")
    elements = spark.createDataFrame([(60,), (17,), (2**31 + 4,), (90_001,)], "element long").repartition(3)
    jobs.land_by_schema(elements, registry(spark), path, window=window)
    landed = files.read_parquet(spark, path, schemas.SCHEMA_ID_ROW)
    assert rows(landed, "my_int", "p_schema_id") == [(17, 1), (2**31 + 4, 0), (60, 0), (90_001, 1)]
    found = part_files(path)
    assert len(found) == 2 and all(len(parts) == 1 for parts in found.values())
    assert {folder.split("/")[0] for folder in found} == {"p_schema_id=0", "p_schema_id=1"}


def test_element_of_unknown_schema_fails_the_job(spark, tmp_path):
    elements = spark.createDataFrame([(5,)], "element int")
    with pytest.raises(PySparkException, match="no schema"):
        jobs.land_by_schema(elements, registry(spark), str(tmp_path / "out"), n_schemas=3)


def test_several_shards_per_destination(spark, tmp_path):
    df = spark.range(3000).withColumn("dest", F.col("id") % 2)
    sink.write_files(sink.by_destination(df, ["dest"], 3, ["id"]), str(tmp_path / "most"), partition_by=["dest"])
    assert all(1 <= len(parts) <= 3 for parts in part_files(tmp_path / "most").values())
    exact = sink.in_exact_shards(df, "dest", [0, 1], 3, ["id"])
    sink.write_files(exact, str(tmp_path / "exact"), partition_by=["dest"])
    assert {k: len(v) for k, v in part_files(tmp_path / "exact").items()} == {"dest=0": 3, "dest=1": 3}
    assert spark.read.parquet(str(tmp_path / "exact")).distinct().count() == 3000
    with pytest.raises(ValueError):
        sink.by_destination(df, ["dest"], 0)


def test_destination_outside_the_list_is_still_written(spark, tmp_path):
    df = spark.range(90).withColumn("dest", F.when(F.col("id") % 3 < 2, F.col("id") % 3))
    sink.write_files(sink.in_exact_shards(df, "dest", [0], 2, ["id"]), str(tmp_path / "out"), partition_by=["dest"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 90


def test_shares_by_largest_remainder():
    assert sink.shares({"a": 50, "b": 30, "c": 20}, 100, 10) == {"a": 5, "b": 3, "c": 2}
    assert sink.shares({"a": 55, "b": 26}, 100, 8) == {"a": 4, "b": 2}  # 4.4 and 2.08: six in all
    assert sink.shares({"a": 47, "b": 47}, 100, 5) == {"a": 3, "b": 2}
    assert sink.shares({"a": 1}, 1000, 4) == {"a": 1}


@pytest.mark.parametrize("num_shards", [1, 3])
def test_a_third_of_the_rows_gets_a_third_of_the_writers(spark, tmp_path, num_shards):
    third = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 1000).cast("string"))
    df = spark.range(60_000).withColumn("dest", third)
    sink.write_files(sink.in_shares(df, "dest", 12, num_shards, ["id"]), str(tmp_path / "out"), partition_by=["dest"])
    found = {k: len(v) for k, v in part_files(tmp_path / "out").items()}
    assert found.pop("dest=__HIVE_DEFAULT_PARTITION__") == 4
    assert len(found) == 1000 and set(found.values()) == {num_shards}
    assert spark.read.parquet(str(tmp_path / "out")).select("id").distinct().count() == 60_000


def test_no_task_writes_much_more_than_its_part(spark):
    dest = F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 8, "b").otherwise((F.col("id") % 500).cast("string"))
    df = sink.in_shares(spark.range(100_000).withColumn("dest", dest), "dest", 20, shard_key=["id"], size=F.lit(7))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert max(sizes) < 1.3 * 100_000 / 20
    assert sink.in_shares(spark.range(0).withColumn("dest", F.lit("x")), "dest", 4).count() == 0
    with pytest.raises(ValueError):
        sink.in_shares(df, "dest", 0)


def test_busy_destination_is_split_over_tasks(spark, tmp_path):
    df = spark.range(400_000).repartition(8).withColumn("dest", F.when(F.rand(1) < 0.9, 0).otherwise(F.col("id") % 20))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sink.write_files(sink.by_destination(df, ["dest"]), str(tmp_path / "out"), partition_by=["dest"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(part_files(tmp_path / "out")["dest=0"]) > 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400_000


def topic_log(spark, n=40):
    topic = F.when(F.col("id") % 2 == 0, "raw").otherwise("raw2")
    value = F.when(F.col("id") % 10 == 9, F.lit(None)).when(F.col("id") % 10 == 8, F.lit("")).otherwise(
        F.format_string('{"id": %d}', "id")
    )
    at = F.timestamp_seconds(F.lit(1700000000) + F.col("id"))
    return envelope.to_log(generate.sequence(spark, n), topic, value, F.col("id"), timestamp=at)


def test_topics_land_as_lines_in_their_own_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    jobs.land_topics(topic_log(spark), path, time="timestamp")
    found = part_files(path)
    assert set(f.split("/")[0] for f in found) == {"topic=raw", "topic=raw2"}
    # 40 seconds from 1700000000, which is on a window edge.
    assert set(found) == {f"topic={t}/window_day=2023-11-14" for t in ("raw", "raw2")}
    starts = files.read_json_lines(spark, path, schemas.TOPIC_LINE).select("window_start").distinct().collect()
    assert {r.window_start for r in starts} == {f"2023-11-14T22-13-{s}" for s in (20, 30, 40, 50)}
    assert not any(":" in name for folder, names in found.items() for name in [folder, *names])
    only_raw = spark.read.schema("value string").json(f"{path}/topic=raw")
    only_raw = only_raw.selectExpr("cast(get_json_object(value, '$.id') as bigint) as id")
    assert sorted(r.id for r in only_raw.collect()) == [i for i in range(0, 40, 2) if i % 10 != 8]
    assert all(open(os.path.join(path, d, f)).read().strip() for d, names in found.items() for f in names)
    text_path = str(tmp_path / "text")
    jobs.land_topics(topic_log(spark), text_path, time="timestamp", fmt="text")
    assert {f.split("window_start=")[1] for f in part_files(text_path)} == {f"2023-11-14T22-13-{s}" for s in (20, 30, 40, 50)}


def test_line_breaks_stay_within_a_record(spark, tmp_path):
    values = ["one", "two\nlines", "\r\n", 'a "quoted"\n\nend\n']
    records = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    jobs.land_topics(envelope.to_log(records, F.lit("raw"), F.col("v"), F.col("id")), str(tmp_path / "out"))
    landed = files.read_json_lines(spark, str(tmp_path / "out"), schemas.TOPIC_LINE)
    assert sorted(r.value for r in landed.collect()) == sorted(values)


def test_short_windows_make_no_more_folders_than_days(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 60)
    log_ = envelope.to_log(spark.range(3000), F.lit("raw"), F.col("id").cast("string"), F.col("id"), timestamp=at)
    jobs.land_topics(log_, str(tmp_path / "days"), window="10 seconds", time="timestamp")
    jobs.land_topics(log_, str(tmp_path / "hours"), window="10 seconds", time="timestamp", folder="hour")
    assert len(part_files(tmp_path / "days")) == 4 and len(part_files(tmp_path / "hours")) == 51
    landed = files.read_json_lines(spark, str(tmp_path / "hours"), schemas.TOPIC_LINE)
    assert landed.select("window_start").distinct().count() == 3000
    with pytest.raises(ValueError, match="folder"):
        jobs.land_topics(log_, str(tmp_path / "no"), window="10 seconds", time="timestamp", folder="week")


def test_days(spark, tmp_path, rows):
    lines = ['{"day": "2023-04-10", "id": 1}', '{"day": "2023-04-09", "id": 2}', '{"id": 3}', "not json"]
    records = spark.createDataFrame(enumerate(lines), "id long, line string")
    jobs.land_days(envelope.to_log(records, F.lit("raw"), F.col("line"), F.col("id"), key=F.lit("1")), str(tmp_path / "out"))
    landed = files.read_parquet(spark, str(tmp_path / "out"), schemas.DAY_EVENT)
    assert rows(landed, "day", "id", "key") == sorted(
        [("2023-04-10", 1, "1"), ("2023-04-09", 2, "1"), (None, 3, "1"), (None, None, "1")], key=repr
    )
    assert "day=__HIVE_DEFAULT_PARTITION__" in part_files(tmp_path / "out")


def test_day_job_has_no_shuffle_and_no_python(spark):
    text = envelope.day_events(topic_log(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def shard_records(spark, n=3):
    return envelope.to_shards(envelope.log_events(generate.sequence(spark, n)), "stream-01", sequence_number=F.col("id").cast("string"), shard_id=F.lit("shard-000"))


def test_shards_land_as_snappy_parquet(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    jobs.land_shards(shard_records(spark), path, window=None)
    landed = files.read_parquet(spark, path, schemas.CONSUMED_EVENT)
    assert rows(landed) == [(0, "shard-000"), (1, "shard-000"), (2, "shard-000")]
    names = [n for parts in part_files(path).values() for n in parts]
    assert all(n.endswith(".snappy.parquet") for n in names)


def test_run_id_and_window_name_the_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    jobs.land_shards(shard_records(spark), path, run_id="abcde", together=True)
    (folder,) = part_files(path)
    assert re.fullmatch(r"run_id=abcde/window_day=\d{4}-\d\d-\d\d", folder)


def test_landing_twice_on_one_path_is_refused_unless_appending(spark, tmp_path):
    path = str(tmp_path / "out")
    jobs.land_shards(shard_records(spark), path, run_id="a")
    with pytest.raises(PySparkException):
        jobs.land_shards(shard_records(spark), path, run_id="b")
    jobs.land_shards(shard_records(spark), path, run_id="b", save_mode="append")
    assert {folder.split("/")[0] for folder in part_files(path)} == {"run_id=a", "run_id=b"}
    assert files.read_parquet(spark, path, schemas.CONSUMED_EVENT).count() == 6


def test_stream_needs_a_checkpoint(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        sink.write_files(stream, str(tmp_path))


def test_record_format_without_the_avro_package(spark):
    assert sink.record_format(spark) in ("avro", "parquet")


def test_jdbc_write_options():
    base = {"url": "jdbc:x", "dbtable": "t"}
    assert jdbc.write_options(base) == base | {"truncate": "true", "numPartitions": "4", "batchsize": "10000"}
    assert jdbc.write_options(base, truncate=False, num_partitions=64)["truncate"] == "false"


class Recorder:
    """Stands in for a frame and its writer; no database is started in these tests."""

    isStreaming = False

    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    columns = ["topic", "key", "value"]

    def select(self, *columns):
        self.calls["select"] = columns
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["saved"] = True


def test_jdbc_write():
    df = Recorder()
    jdbc.write_jdbc(df, jdbc.write_options({"url": "u", "dbtable": "t"}))
    assert df.calls["format"] == "jdbc" and df.calls["mode"] == "overwrite" and df.calls["saved"]
    assert df.calls["options"]["batchsize"] == "10000"


def test_kafka_write_leaves_the_topic_to_the_option_when_there_is_one():
    df = Recorder()
    log.write_kafka(df, log.kafka_write_options("b", "raw"))
    assert df.calls["select"] == ("key", "value") and df.calls["options"]["topic"] == "raw"
    df = Recorder()
    log.write_kafka(df, log.kafka_write_options("b"))
    assert df.calls["select"] == ("topic", "key", "value")
