"""The registered queries: each runs an operator, source, sink or job over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import codec, keys, text
from millrace.functions.times import instant
from millrace.operators import audit, combine, envelope, filters, intervals, lookup, metrics, outbox, windows
from millrace.plans.staging import (
    SHARD_POSITION,
    day_log,
    event_ids,
    files_per_batch,
    shard_log,
    stage,
    table,
    topic_log,
    value_with_nulls,
)
from millrace.session import scratch_dir, written
from millrace.sinks.files import UNTIL_CAUGHT_UP, in_exact_shards, in_shares, write_files
from millrace.sinks.log import append_log
from millrace.sources import files, generate, log, manifest, start
from millrace.streaming import jobs
from millrace.streaming import records as shaped_records

MID_MONTH = "timestamp_ntz'2024-01-15 00:00:00'"
TOPICS = "click,error,purchase,signup,view"
REGISTRY = [(0, "schema-0"), (1, "schema-1")]
REGISTRY_SCHEMA = "schema_id int, schema string"

# Two records with little in common: a nested one with a time, and one with an enumeration, a default and an empty field.
EVEN_RECORD = """{"type": "record", "name": "Even", "namespace": "example", "fields": [
  {"name": "my_int", "type": "long"},
  {"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}},
  {"name": "who", "type": {"type": "record", "name": "Who", "fields": [{"name": "user_id", "type": "long"}]}}]}"""
ODD_RECORD = """{"type": "record", "name": "Odd", "namespace": "example", "fields": [
  {"name": "my_int", "type": "int"},
  {"name": "kind", "aliases": ["event_type"],
   "type": {"type": "enum", "name": "Kind", "symbols": ["click", "error", "purchase", "signup", "view"]}},
  {"name": "origin", "type": "string", "default": "events"},
  {"name": "note", "type": ["null", "string"], "default": null}]}"""
RECORDS = [(0, EVEN_RECORD), (1, ODD_RECORD)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Projections and scalar functions


@query
def user_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = event_ids(table(spark, sf_dir, "events"))
    return ids.select("id", text.user_name("id").alias("user_name"))


@query
def names_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/customer.parquet").select("c_name")


@query
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select("event_id", text.from_json_text("props", "k bigint").alias("j"))
        .selectExpr("event_id", "j.k")
    )


@query
def utf8_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = value_with_nulls().cast("binary")
    return table(spark, sf_dir, "events").select("event_id", text.value_text(value).alias("v"))


@query
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "events").select("event_id", value_with_nulls().alias("v"))
    return filters.drop_empty(records, "v")


@query
def case_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "case when true then 'abc' end as my_col")


@query
def producer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = event_ids(table(spark, sf_dir, "events"))
    records = envelope.produced_records(ids, "raw")
    return records.select(
        "topic", F.hex("key").alias("key_hex"), text.utf8("value").alias("value")
    )


@query
def encoded_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short payloads and ten-byte payloads, there and back."""
    wide = F.when(F.col("event_id") % 2 == 0, F.col("event_id")).otherwise(-F.col("event_id") - F.lit(1 << 62))
    payloads = codec.encode_long(table(spark, sf_dir, "events").select("event_id", wide.alias("wide")), "wide")
    return codec.decode_long(payloads, "data", "decoded").select("event_id", F.hex("data").alias("payload"), "decoded")


@query
def shard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.consumed_events(shard_log(table(spark, sf_dir, "events")))


@query
def shard_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread over four shards by a repeatable key, written to a shard log and read back."""
    payloads = envelope.log_events(event_ids(table(spark, sf_dir, "events")))
    key = keys.partition_key("hash", "id")
    path = scratch_dir(spark, "shard-writer")
    number = F.col("id").cast("string")
    append_log(envelope.to_shards(payloads, "events", partition_key=key, sequence_number=number, n_shards=4), path)
    landed = log.read_shards(spark, path, streaming=False)
    return envelope.consumed_events(landed, keep=("partition_key",))


# Start positions


@query
def start_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    position = start.StartPosition.parse(start.AT_TIMESTAMP, "2024-01-15T00:00:00.00Z")
    state = scratch_dir(spark, "start-at")
    return start.apply_start(events, events, position, state, timestamp="ts").select("event_id")


@query
def start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), keys.bucket("user_id", 2).alias("partition"), "event_id", "ts"
    )
    before = events.where(F.col("ts") < F.expr(MID_MONTH))
    ends = written(start.last_offsets(before, ["topic", "partition"], "event_id"), "ends")
    return start.after(events, ends, ["topic", "partition"], "event_id").select("event_id")


@query
def log_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest of a log that was appended to twice says of each shard, without a look at the log."""
    events = table(spark, sf_dir, "events")
    path = scratch_dir(spark, "manifest")
    for part in (events.where(F.col("ts") < F.expr(MID_MONTH)), events.where(F.col("ts") >= F.expr(MID_MONTH))):
        stage(shard_log(part), path, events.count(), manifest_of=SHARD_POSITION)
    held = manifest.up_to_date(spark, path, schemas.SHARD_ENVELOPE, *[[SHARD_POSITION[0]], *SHARD_POSITION[1:]])
    return held.groupBy("shard_id").agg(
        F.sum("n").alias("n"),
        F.max("last_offset.value").cast("bigint").alias("last_id"),
        F.unix_micros(F.min("first_time")).alias("first_micros"),
        F.unix_micros(F.max("last_time")).alias("last_micros"),
    )


@query
def start_latest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive after the first start; files that were there before it are not opened again."""
    events = table(spark, sf_dir, "events")
    rows = events.count()
    work = scratch_dir(spark, "start-files")
    path, (shard, number, arrival) = f"{work}/log", SHARD_POSITION
    latest = start.StartPosition(start.LATEST)

    def read() -> DataFrame:
        found = log.read_shards(spark, path, streaming=False)
        return start.apply_start(found, None, latest, f"{work}/start", (shard,), number, arrival, path)

    stage(shard_log(events.where(F.col("ts") < F.expr(MID_MONTH))), path, rows, manifest_of=SHARD_POSITION)
    read()
    stage(shard_log(events.where(F.col("ts") >= F.expr(MID_MONTH))), path, rows, manifest_of=SHARD_POSITION)
    return envelope.consumed_events(read())


# Windows


@query
def window_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts_per_window(table(spark, sf_dir, "events"), "5 seconds", "ts", ["event_type"])


@query
def window_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts_per_window(table(spark, sf_dir, "events"), "10 seconds", "ts", ["event_type"])


@query
def window_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts_per_window(table(spark, sf_dir, "events"), "60 seconds", "ts", ["event_type"])


# Lookup, combining, distinct


@query
def schema_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    found = jobs.schema_records(table(spark, sf_dir, "events"), registry, "event_id")
    return found.withColumnRenamed("schema", "schema_name")


@query
def schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three schema ids, of which the registry knows two: the third is marked, and kept."""
    registry = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    elements = table(spark, sf_dir, "events").select(
        "event_id", keys.bucket("event_id", 3).cast("int").alias("schema_id")
    )
    marked = lookup.with_schema(elements, registry, on_missing="mark")
    return marked.select("event_id", F.col("schema").alias("schema_name"), "schema_found")


@query
def combine_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each schema id, combined three ways in one pass over their partial aggregates."""
    pairs = table(spark, sf_dir, "events").select(keys.bucket("event_id", 2).alias("schema_id"), "user_id")
    ways = lambda v: F.struct(F.min(v).alias("least"), F.sum(v).alias("total"), F.bit_xor(v).alias("mixed"))
    return combine.combine_per_key(pairs, "schema_id", "user_id", ways, "v").select("schema_id", "v.*")


@query
def combine_per_key_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product modulo a prime, which no aggregate of Spark computes."""
    pairs = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 997 + 1).alias("v"))
    return combine.combine_per_key_with(pairs, "event_type", "v", lambda a, b: a * b % 1_000_003)


@query
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(keys.bucket("event_id", 2).alias("schema_id"))
    return combine.distinct_keys(ids, "schema_id")


@query
def schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids in use mapped to their schemas, entry by entry."""
    ids = written(distinct_keys(spark, sf_dir), "schema-ids")
    known = F.when(F.col("schema_id").isin(0, 1), F.concat(F.lit("schema-"), F.col("schema_id").cast("string")))
    named = ids.select("schema_id", F.coalesce(known, F.raise_error(F.lit("unknown schema id"))).alias("schema_name"))
    return lookup.map_entries(named, "schema_id", "schema_name")


# Audits


@query
def count_and_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_and_distinct(table(spark, sf_dir, "events"), "event_id")


@query
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_row_count(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query
def rows_per_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rows_per(table(spark, sf_dir, "events").select(keys.bucket("user_id", 2).alias("shard")), "shard")


def _faulty_landing(events: DataFrame) -> DataFrame:
    """Some ids never landed, some landed twice."""
    ids = event_ids(events).where("id % 101 <> 0")
    return ids.union(ids.where("id % 103 = 0"))


@query
def exactly_once_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return audit.exactly_once(_faulty_landing(events), event_ids(events))


@query
def sequence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids against the generated sequence that they should be."""
    events = table(spark, sf_dir, "events")
    return audit.exactly_once(event_ids(events), generate.sequence(spark, events.count()))


@query
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return audit.multiset_diff(event_ids(events), _faulty_landing(events))


@query
def topic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_partition(topic_log(table(spark, sf_dir, "events")))


@query
def outbox_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select("event_id", keys.bucket("user_id", 2).alias("bucket"))
    return outbox.to_messages(ids, "event_id", "bucket", unique=True).select("bucket", "batch_no", "body")


@query
def outbox_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that occur many times, in a bucket for each event type."""
    messages = outbox.to_messages(table(spark, sf_dir, "events"), "user_id", "event_type")
    return messages.select("bucket", "batch_no", "message_id", "body")


# Sinks: written to a new folder and read back


@query
def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "keyed-lines")
    line = F.concat_ws(":", keys.bucket("event_id", 11).cast("string"), "props")
    write_files(table(spark, sf_dir, "events").select(line.alias("value")), path, "text")
    records = files.keyed_lines(files.read_text_lines(spark, path))
    return records.select(text.key_text("key").alias("key"), text.value_text("value").alias("value"))


@query
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced messages landed as text lines and read as JSON."""
    path = scratch_dir(spark, "json-lines")
    records = envelope.produced_records(event_ids(table(spark, sf_dir, "events")), "raw")
    write_files(records.select(text.utf8("value").alias("value")), path, "text")
    return files.read_json_lines(spark, path, "id bigint")


@query
def rows_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day job end to end: a log of JSON values, streamed into Parquet by day, counted."""
    events = table(spark, sf_dir, "events")
    work = scratch_dir(spark, "rows-per-day")
    source = stage(day_log(events), f"{work}/log", events.count())
    records = log.read_log(spark, source, "raw", max_files_per_trigger=files_per_batch(spark, source))
    jobs.land_days(records, f"{work}/out", f"{work}/checkpoint", trigger=UNTIL_CAUGHT_UP).awaitTermination()
    return audit.rows_per(files.read_parquet(spark, f"{work}/out", schemas.DAY_EVENT), "day")


@query
def days_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job over bounded input; values without a day land in the null folder."""
    events = table(spark, sf_dir, "events")
    path = scratch_dir(spark, "days-batch")
    day = F.when(F.col("event_id") % 97 != 0, F.to_date("ts").cast("string"))
    jobs.land_days(day_log(events, day), path, together=True)
    return audit.rows_per(files.read_parquet(spark, path, schemas.DAY_EVENT), "day")


@query
def topic_window_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "topic-windows")
    records = topic_log(table(spark, sf_dir, "events"), F.col("props"))
    jobs.land_topics(records, path, window="10 seconds", time="timestamp")
    return audit.rows_per(files.read_json_lines(spark, path, schemas.TOPIC_LINE), "topic", "window_start")


@query
def schema_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "schema-ids")
    registry = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    jobs.land_by_schema(table(spark, sf_dir, "events"), registry, path, "event_id")
    landed = files.read_parquet(spark, path, schemas.SCHEMA_ID_ROW)
    return landed.select("my_int", F.col("p_schema_id").cast("string").alias("p_schema_id"))


def _schema_elements(events: DataFrame) -> DataFrame:
    """Elements with everything that either record takes, and the id of theirs."""
    return events.select(
        keys.bucket("event_id", 2).cast("int").alias("schema_id"),
        "event_id",
        instant("ts").alias("at"),
        F.struct("user_id").alias("who"),
        "event_type",
    )


def _record_layouts(spark: SparkSession, path: str) -> DataFrame:
    """All records landed below a path, each with the columns that the files of its schema id really have."""
    found = []
    for schema_id, text in RECORDS:
        layout = spark.read.parquet(f"{path}/p_schema_id={schema_id}").drop(shaped_records.BATCH).schema.simpleString()
        of = shaped_records.read_records(spark, path, schema_id, text, "parquet")
        also = [F.unix_micros("at").alias("at_micros"), F.col("who.user_id")] if schema_id == 0 else ["kind", "origin", "note"]
        found.append(of.select(F.lit(schema_id).alias("p_schema_id"), F.lit(layout).alias("layout"), F.col("my_int").cast("bigint"), *also))
    return found[0].unionByName(found[1], allowMissingColumns=True)


@query
def schema_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event in the record of its schema id: two schemas, two layouts."""
    path = scratch_dir(spark, "schema-records")
    registry = spark.createDataFrame(RECORDS, REGISTRY_SCHEMA)
    elements = _schema_elements(table(spark, sf_dir, "events"))
    shaped_records.land_records(elements, registry, path, sources={"my_int": "event_id"}, fmt="parquet")
    return _record_layouts(spark, path)


@query
def exact_shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files for each of two destinations: rows and files found per destination."""
    path = scratch_dir(spark, "exact-shards")
    rows = table(spark, sf_dir, "events").select("event_id", keys.bucket("event_id", 2).alias("dest"))
    write_files(in_exact_shards(rows, "dest", [0, 1], 3, ["event_id"]), path, partition_by=["dest"])
    landed = files.read_parquet(spark, path, "event_id bigint, dest bigint").withColumn("file", F.input_file_name())
    per_file = landed.groupBy("dest", "file").agg(F.count("*").alias("n"))
    return per_file.groupBy("dest").agg(F.sum("n").alias("n"), F.count("*").alias("files"))


@query
def shared_shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows have one destination, the others go by their type: rows and files found per destination."""
    path = scratch_dir(spark, "shared-shards")
    dest = F.when(F.col("event_id") % 3 == 0, "hot").when(F.col("event_id") % 50 == 1, F.col("event_type")).otherwise(F.lit("rest"))
    rows = table(spark, sf_dir, "events").select("event_id", dest.alias("dest"))
    write_files(in_shares(rows, "dest", 12, shard_key=["event_id"]), path, partition_by=["dest"])
    landed = files.read_parquet(spark, path, "event_id bigint, dest string").withColumn("file", F.input_file_name())
    per_file = landed.groupBy("dest", "file").agg(F.count("*").alias("n"))
    return per_file.groupBy("dest").agg(F.sum("n").alias("n"), F.count("*").alias("files"))


# Streams over several micro-batches


def _stage_shards(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    events = table(spark, sf_dir, "events")
    work = scratch_dir(spark, name)
    stage(shard_log(events), f"{work}/log", events.count())
    return events, work


def _shard_stream(spark: SparkSession, work: str) -> DataFrame:
    path = f"{work}/log"
    return log.read_shards(spark, path, max_files_per_trigger=files_per_batch(spark, path))


def _land(records: DataFrame, work: str, **options) -> None:
    """Catch up with a shard log in windows of sixty seconds of arrival time."""
    options = {"window": "60 seconds", "time": "approximate_arrival_timestamp", "together": True} | options
    jobs.land_shards(
        records, f"{work}/out", f"{work}/checkpoint", trigger=UNTIL_CAUGHT_UP, **options
    ).awaitTermination()


def _landed(spark: SparkSession, work: str) -> DataFrame:
    return files.read_parquet(spark, f"{work}/out", schemas.CONSUMED_EVENT).select("id", "shard_id")


@query
def stream_shard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty-second windows of processing time, as the job runs by default."""
    _, work = _stage_shards(spark, sf_dir, "shard-events")
    _land(_shard_stream(spark, work), work, time=None)
    return _landed(spark, work)


@query
def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics in one source, empty values left out."""
    events = table(spark, sf_dir, "events")
    work = scratch_dir(spark, "topics")
    source = stage(topic_log(events), f"{work}/log", events.count(), by_topic=True)
    records = log.read_log(spark, source, TOPICS, max_files_per_trigger=files_per_batch(spark, source))
    jobs.land_topics(
        records, f"{work}/out", f"{work}/checkpoint", "10 seconds", "timestamp", trigger=UNTIL_CAUGHT_UP
    ).awaitTermination()
    return files.read_json_lines(spark, f"{work}/out", schemas.TOPIC_LINE).select("topic", "value")


@query
def stream_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record counts per topic as each micro-batch stored them, summed over the batches."""
    events = table(spark, sf_dir, "events")
    work = scratch_dir(spark, "tap")
    source = stage(topic_log(events), f"{work}/log", events.count())
    records = log.read_log(spark, source, TOPICS, max_files_per_trigger=files_per_batch(spark, source))
    metrics.record(records, f"{work}/metrics", f"{work}/checkpoint", UNTIL_CAUGHT_UP).awaitTermination()
    return metrics.recorded(spark, f"{work}/metrics").groupBy("topic").agg(F.sum("n").alias("n"))


@query
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit by topic from intervals kept batch by batch: no landed record is read a second time."""
    events = table(spark, sf_dir, "events")
    work = scratch_dir(spark, "intervals")
    landed = events.where("event_id % 101 <> 0")
    landed = landed.unionByName(landed.where("event_id % 103 = 0"))
    source = stage(topic_log(landed), f"{work}/log", events.count())
    records = log.read_log(spark, source, TOPICS, max_files_per_trigger=files_per_batch(spark, source))
    ids = records.select("topic", F.col("offset").alias("id"))
    intervals.record(ids, f"{work}/state", f"{work}/checkpoint", UNTIL_CAUGHT_UP, by=["topic"]).awaitTermination()
    expected = intervals.of_ids(events.select(F.col("event_type").alias("topic"), "event_id"), "event_id", ["topic"])
    return intervals.exactly_once(intervals.recorded(spark, f"{work}/state"), expected, ["topic"])


@query
def stream_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows, a side table and dynamic destinations in one streaming job."""
    _, work = _stage_shards(spark, sf_dir, "by-schema")
    registry = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    time = "approximate_arrival_timestamp"
    elements = envelope.consumed_events(_shard_stream(spark, work), keep=(time,))
    jobs.land_by_schema(
        elements,
        registry,
        f"{work}/out",
        "id",
        window="60 seconds",
        time=time,
        checkpoint=f"{work}/checkpoint",
        trigger=UNTIL_CAUGHT_UP,
    ).awaitTermination()
    return files.read_parquet(spark, f"{work}/out", schemas.SCHEMA_ID_ROW).select("my_int", "p_schema_id")


@query
def stream_schema_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry gets its second schema while the stream is down, and the first batch that needs it looks it up."""
    events = table(spark, sf_dir, "events")
    rows = events.count()
    work = scratch_dir(spark, "stream-records")
    elements = _schema_elements(events)
    for entry in RECORDS:
        spark.createDataFrame([entry], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{work}/registry")
        part = elements.where(F.col("schema_id") == entry[0])
        part.write.option("maxRecordsPerFile", max(1, rows // 4)).mode("append").parquet(f"{work}/elements")
        arriving = spark.readStream.schema(elements.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/elements")
        shaped_records.land_records(
            arriving,
            lambda s: s.read.schema(REGISTRY_SCHEMA).parquet(f"{work}/registry"),
            f"{work}/out",
            sources={"my_int": "event_id"},
            fmt="parquet",
            checkpoint=f"{work}/checkpoint",
            trigger=UNTIL_CAUGHT_UP,
        ).awaitTermination()
    return _record_layouts(spark, f"{work}/out")


@query
def stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded number of files per micro-batch, audited."""
    events, work = _stage_shards(spark, sf_dir, "admission")
    _land(_shard_stream(spark, work), work)
    return audit.exactly_once(_landed(spark, work), event_ids(events))


@query
def stream_start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive after the first start; a restart with another mode changes nothing."""
    events = table(spark, sf_dir, "events")
    rows = events.count()
    work = scratch_dir(spark, "start-latest")
    cut = F.expr(MID_MONTH)
    path, keyed = f"{work}/log", ("shard_id",)
    stage(shard_log(events.where(F.col("ts") < cut)), path, rows)

    def run(position: start.StartPosition) -> None:
        records = start.apply_start(
            _shard_stream(spark, work),
            None,
            position,
            f"{work}/start",
            keys=keyed,
            offset="sequence_number",
            timestamp="approximate_arrival_timestamp",
            path=path,
        )
        _land(records, work)

    run(start.StartPosition(start.LATEST))
    stage(shard_log(events.where(F.col("ts") >= cut)), path, rows)
    run(start.StartPosition(start.LATEST))
    run(start.StartPosition(start.TRIM_HORIZON))
    return _landed(spark, work).select("id")


@query
def stream_start_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrived at an instant or later."""
    _, work = _stage_shards(spark, sf_dir, "start-at")
    records = start.apply_start(
        _shard_stream(spark, work),
        None,
        start.StartPosition.parse(start.AT_TIMESTAMP, "2024-01-15T00:00:00.00Z"),
        f"{work}/start",
        keys=("shard_id",),
        offset="sequence_number",
        timestamp="approximate_arrival_timestamp",
        path=f"{work}/log",
    )
    _land(records, work)
    return _landed(spark, work).select("id")


@query
def stream_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shards become four half-way; audited shard by shard."""
    events = table(spark, sf_dir, "events")
    rows = events.count()
    half = rows // 2
    work = scratch_dir(spark, "reshard")
    first, second = events.where(F.col("event_id") < half), events.where(F.col("event_id") >= half)
    for part, n_shards in ((first, 2), (second, 4)):
        stage(shard_log(part, n_shards), f"{work}/log", rows)
        _land(_shard_stream(spark, work), work)
    n_shards = F.when(F.col("event_id") < half, 2).otherwise(4)
    expected = events.select(
        F.col("event_id").alias("id"), keys.shard_name(F.col("user_id") % n_shards).alias("shard_id")
    )
    return audit.exactly_once(_landed(spark, work), expected, by=["shard_id"])


@query
def stream_crash_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record fails the stream; restarted without the fault, nothing is lost or repeated."""
    events, work = _stage_shards(spark, sf_dir, "crash-resume")
    poison = events.agg(F.max("event_id")).first()[0]
    records = _shard_stream(spark, work)
    fault = F.raise_error(F.lit("injected fault")).cast("binary")
    struck = F.when(F.col("sequence_number").cast("bigint") == poison, fault).otherwise(F.col("data"))
    try:
        _land(records.withColumn("data", struck), work)
    except StreamingQueryException:
        _land(records, work)
    else:
        raise AssertionError("the injected fault did not stop the stream")
    return audit.exactly_once(_landed(spark, work), event_ids(events))


@query
def stream_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped half-way and restarted on the same checkpoint, with fewer tasks to read and to write."""
    events = table(spark, sf_dir, "events")
    rows = events.count()
    work = scratch_dir(spark, "rescale")
    cores = spark.sparkContext.defaultParallelism
    first, second = events.where(F.col("event_id") % 2 == 0), events.where(F.col("event_id") % 2 == 1)
    for part, tasks in ((first, max(3, cores * 3 // 4)), (second, max(2, cores // 2))):
        stage(shard_log(part), f"{work}/log", rows)
        _land(_shard_stream(spark, work).coalesce(tasks), work, width=tasks)
    return audit.exactly_once(_landed(spark, work), event_ids(events))
