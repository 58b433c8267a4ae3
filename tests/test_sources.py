from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import text
from millrace.operators import envelope
from millrace.sinks.log import append_log, kafka_write_options
from millrace.sources import files, generate, jdbc, log
from millrace.sources.start import AT_TIMESTAMP, LATEST, TRIM_HORIZON, StartPosition
from millrace.streaming import jobs

KEYED_LINES = ["north:left at dawn", "south:ratio 3:4", "north:", "east: spaced "]


def test_sequence(spark):
    assert [r.id for r in generate.sequence(spark, 5).collect()] == [0, 1, 2, 3, 4]
    assert generate.sequence(spark, 0).count() == 0


def test_paced_sequence_ends_with_its_last_id(spark, tmp_path):
    stream = generate.paced_sequence(spark, 25, per_second=10)
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="1 second")
        .start()
    )
    generate.run_to_end(query, 25, timeout=120)
    landed = spark.read.schema("id long, timestamp timestamp").parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in landed.collect()) == list(range(25))
    assert [r["count"] for r in landed.groupBy("timestamp").count().orderBy("timestamp").collect()] == [10, 10, 5]
    assert not query.isActive


def test_keyed_json_lines_by_day(spark, tmp_path, rows):
    """Two files of lines, one value without a day and one that is no JSON, loaded as records and landed by day."""
    (tmp_path / "lines").mkdir()
    leap = ['pump:{"id": %d, "day": "2020-02-29"}' % n for n in (700, 40, 5)]
    rest = ['valve:{"day": "2021-12-31", "id": 81, "unit": "bar"}', 'valve:{"id": 6}', "pump:not json"]
    (tmp_path / "lines" / "first.txt").write_text("\n".join(leap) + "\n")
    (tmp_path / "lines" / "second.txt").write_text("\n".join(rest) + "\n")
    records = files.keyed_lines(files.read_text_lines(spark, str(tmp_path / "lines")))
    jobs.land_days(records, str(tmp_path / "out"))
    landed = files.read_parquet(spark, str(tmp_path / "out"), schemas.DAY_EVENT)
    assert rows(landed.groupBy("day").count()) == sorted([("2020-02-29", 3), ("2021-12-31", 1), (None, 2)], key=repr)
    assert rows(landed.where("key = 'valve'"), "id") == sorted([(81,), (6,)], key=repr)


def test_keyed_lines(spark, tmp_path, rows):
    (tmp_path / "lines.txt").write_text("\n".join([*KEYED_LINES, "no delimiter", ":empty key", "k:"]) + "\n")
    records = files.keyed_lines(files.read_text_lines(spark, str(tmp_path)))
    got = rows(records.select(F.col("key").cast("string"), F.col("value").cast("string")))
    expected = [tuple(line.split(":", 1)) for line in KEYED_LINES]
    assert got == sorted([*expected, (None, "no delimiter"), ("", "empty key"), ("k", "")], key=repr)


def test_longer_delimiter(spark):
    lines = spark.createDataFrame([("a=>b=>c",)], "value string")
    row = files.keyed_lines(lines, "=>").first()
    assert (bytes(row.key), bytes(row.value)) == (b"a", b"b=>c")


def test_json_and_parquet_files(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert rows(files.read_json_lines(spark, str(tmp_path), "id bigint")) == [(1,), (2,)]
    spark.range(3).withColumn("name", text.user_name("id")).write.parquet(str(tmp_path / "p"))
    names = files.read_parquet(spark, str(tmp_path / "p")).select("name")
    assert names.count() == 3 and names.columns == ["name"]


def topic_records(spark, n):
    ids = generate.sequence(spark, n)
    topic = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int"))
    return envelope.to_log(ids, topic, text.id_json("id"), F.col("id"))


def test_log_reads_the_topics_asked_for(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(topic_records(spark, 30), path, by_topic=True)
    got = log.read_log(spark, path, "a, c", streaming=False)
    assert got.schema == log.read_log(spark, path, streaming=False).schema
    assert {(r.topic, r["count"]) for r in got.groupBy("topic").count().collect()} == {("a", 10), ("c", 10)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [topic" in plan
    assert [(f.name, f.dataType) for f in got.select(schemas.LOG_ENVELOPE.names).schema] == [
        (f.name, f.dataType) for f in schemas.LOG_ENVELOPE
    ]


def test_log_streams_a_bounded_number_of_files_at_a_time(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(topic_records(spark, 30).coalesce(1), path, max_records_per_file=10)
    stream = log.read_log(spark, path, max_files_per_trigger=1)
    query = stream.writeStream.format("memory").queryName("bounded").trigger(availableNow=True).start()
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert batches == [10, 10, 10] and spark.table("bounded").count() == 30


def test_kafka_options():
    start = StartPosition.parse(AT_TIMESTAMP, "2024-02-01T06:00:00.00Z")
    got = log.kafka_options(
        "b:9092",
        "raw, raw2",
        start,
        {"group.id": "g", "security.protocol": "PLAINTEXT"},
        {"security.protocol": "SSL"},
        max_offsets_per_trigger=500,
    )
    assert got == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "raw,raw2",
        "startingTimestamp": "1706767200000",
        "startingOffsetsByTimestampStrategy": "latest",
        "kafka.group.id": "g",
        "kafka.security.protocol": "SSL",
        "kafka.isolation.level": "read_committed",
        "maxOffsetsPerTrigger": "500",
    }
    assert log.kafka_options("b", "t")["startingOffsets"] == "latest"
    assert log.kafka_options("b", "t", StartPosition(TRIM_HORIZON))["startingOffsets"] == "earliest"
    assert kafka_write_options("b", "t", {"acks": "all"}) == {
        "kafka.bootstrap.servers": "b",
        "kafka.acks": "all",
        "topic": "t",
    }
    with pytest.raises(ValueError):
        log.kafka_options("b", " , ")


def test_start_position_text():
    assert StartPosition.parse() == StartPosition(LATEST)
    when = StartPosition.parse(AT_TIMESTAMP, "2024-02-01T06:00:00.00Z").start_ts
    assert when == datetime(2024, 2, 1, 6, 0, 0, tzinfo=timezone.utc)
    for bad in (("EARLIEST", None), (AT_TIMESTAMP, None), (LATEST, "2024-02-01T06:00:00Z")):
        with pytest.raises(ValueError):
            StartPosition.parse(*bad)


def test_jdbc_read_options():
    connection = jdbc.connection_options(jdbc.mysql_url("h", 3306, "db"), "t", jdbc.MYSQL_DRIVER, "u", "p")
    assert connection == {
        "url": "jdbc:mysql://h:3306/db?rewriteBatchedStatements=true",
        "dbtable": "t",
        "driver": "com.mysql.cj.jdbc.Driver",
        "user": "u",
        "password": "p",
    }
    assert jdbc.read_options(connection) == connection | {"fetchsize": "10000"}
    split = jdbc.read_options(connection, "id", 0, 1000, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id",
        "0",
        "1000",
        "8",
    )
    with pytest.raises(ValueError):
        jdbc.read_options(connection, "id")
    assert jdbc.sqlserver_url("h", 1433, "tempdb") == "jdbc:sqlserver://h:1433;databaseName=tempdb;"
