"""The jobs from the command line: ``python -m millrace <job> ...``, or through spark-submit.

Records come from a broker when ``--bootstrap-servers`` is given, from a connector when
``--connector`` is, and otherwise from a file log.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import keys, text
from millrace.operators import audit, envelope
from millrace.sinks import jdbc as jdbc_sink
from millrace.sinks.files import UNTIL_CAUGHT_UP
from millrace.sinks.log import append_log, kafka_write_options, write_kafka
from millrace.sources import generate, jdbc, log, start
from millrace.streaming import jobs

EVERY_SECOND = {"processingTime": "1 second"}


def _pairs(given: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in given)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)

    def landing(name: str, about: str, window: str | None) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=about)
        p.add_argument("--output", required=True, help="directory or URI to land files in")
        p.add_argument("--checkpoint", required=True, help="progress of the stream; keep it to resume")
        p.add_argument("--input", help="file log to read")
        p.add_argument("--start-mode", default=start.LATEST, choices=start.MODES, help="ignored when resuming")
        p.add_argument("--start-ts", help="like 2024-02-01T06:00:00.00Z, with AT_TIMESTAMP only")
        p.add_argument("--until-caught-up", action="store_true", help="stop once everything present has landed")
        p.add_argument("--max-files-per-trigger", type=int)
        if window:
            p.add_argument("--window", default=window)
        return p

    for name, about, window in (
        ("land-topics", "values as text lines, by topic and window", "10 seconds"),
        ("land-days", "JSON values as Parquet, by day", None),
    ):
        p = landing(name, about, window)
        p.add_argument("--topics", required=True, help="comma-separated")
        p.add_argument("--bootstrap-servers")
        p.add_argument("--consumer-prop", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--security-prop", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--max-offsets-per-trigger", type=int)

    p = landing("land-shards", "shard records as Parquet, by window", "60 seconds")
    p.add_argument("--connector", help="format name of a sharded-stream source")
    p.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    p.add_argument("--run-id")
    p.add_argument("--mode", default="FAILFAST", choices=("FAILFAST", "PERMISSIVE"))

    for name, about in (("produce-topic", "JSON records at a set rate"), ("produce-shards", "log events at a set rate")):
        p = commands.add_parser(name, help=about)
        p.add_argument("--messages", type=int, required=True)
        p.add_argument("--per-second", type=int, required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--output", help="file log to append to")
        if name == "produce-topic":
            p.add_argument("--topic", required=True)
            p.add_argument("--bootstrap-servers")
        else:
            p.add_argument("--stream", default="stream-01")
            p.add_argument("--shards", type=int, default=1)

    p = commands.add_parser("fill-table", help="generated users into a database table")
    p.add_argument("--rows", type=int, required=True)
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--driver")
    p.add_argument("--user")
    p.add_argument("--password-variable", help="environment variable that holds the password")
    p.add_argument("--connections", type=int, default=4)
    p.add_argument("--batchsize", type=int, default=10_000)
    p.add_argument("--no-truncate", action="store_true")

    p = commands.add_parser("audit", help="landed ids against 0 to n - 1")
    p.add_argument("--input", required=True)
    p.add_argument("--format", default="parquet", choices=("parquet", "json"))
    p.add_argument("--schema", default="id bigint")
    p.add_argument("--id", default="id")
    p.add_argument("--expected", type=int, required=True)
    p.add_argument("--per", help="also count rows per value of this column")
    return top


def _topic_records(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    position = start.StartPosition.parse(a.start_mode, a.start_ts)
    if a.bootstrap_servers:
        options = log.kafka_options(
            a.bootstrap_servers,
            a.topics,
            position,
            _pairs(a.consumer_prop),
            _pairs(a.security_prop),
            a.max_offsets_per_trigger,
        )
        return log.read_kafka(spark, options)
    records = log.read_log(spark, a.input, a.topics, max_files_per_trigger=a.max_files_per_trigger)
    return start.apply_start(records, None, position, f"{a.checkpoint}/start", path=a.input)


def _shard_records(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    position = start.StartPosition.parse(a.start_mode, a.start_ts)
    if a.connector:
        # A connector's own options say where it starts.
        if position != start.StartPosition.parse():
            raise SystemExit("with --connector, give the start position among its options (--option)")
        return log.read_shards(spark, connector=a.connector, options=_pairs(a.option))
    records = log.read_shards(spark, a.input, max_files_per_trigger=a.max_files_per_trigger)
    return start.apply_start(
        records,
        None,
        position,
        f"{a.checkpoint}/start",
        keys=("shard_id",),
        offset="sequence_number",
        timestamp="approximate_arrival_timestamp",
        path=a.input,
    )


def _produced(spark: SparkSession, a: argparse.Namespace) -> StreamingQuery:
    ids = generate.paced_sequence(spark, a.messages, a.per_second)
    if a.job == "produce-shards":
        records = envelope.to_shards(
            envelope.log_events(ids),
            a.stream,
            sequence_number=text.zero_padded("id", 20),
            n_shards=a.shards,
            arrival=F.col("timestamp"),
        )
    elif a.bootstrap_servers:
        options = kafka_write_options(a.bootstrap_servers, a.topic)
        return write_kafka(envelope.produced_records(ids, a.topic), options, a.checkpoint, EVERY_SECOND)
    else:
        records = envelope.to_log(
            ids,
            F.lit(a.topic),
            text.id_json("id"),
            F.col("id"),
            key=keys.long_key(keys.bucket("id", 11)),
            timestamp=F.col("timestamp"),
        )
    return append_log(records, a.output, checkpoint=a.checkpoint, trigger=EVERY_SECOND)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"millrace-{a.job}").getOrCreate()

    if a.job.startswith("land-"):
        trigger = UNTIL_CAUGHT_UP if a.until_caught_up else None
        if a.job == "land-topics":
            query = jobs.land_topics(_topic_records(spark, a), a.output, a.checkpoint, a.window, fmt="text", trigger=trigger)
        elif a.job == "land-days":
            query = jobs.land_days(_topic_records(spark, a), a.output, a.checkpoint, trigger=trigger)
        else:
            query = jobs.land_shards(
                _shard_records(spark, a),
                a.output,
                a.checkpoint,
                a.window,
                run_id=a.run_id,
                mode=a.mode,
                trigger=trigger,
            )
        query.awaitTermination()
    elif a.job.startswith("produce-"):
        generate.run_to_end(_produced(spark, a), a.messages, timeout=60 + 10 * a.messages / a.per_second)
    elif a.job == "fill-table":
        password = os.environ[a.password_variable] if a.password_variable else None
        connection = jdbc.connection_options(a.url, a.table, a.driver, a.user, password)
        options = jdbc_sink.write_options(connection, not a.no_truncate, a.connections, a.batchsize)
        jdbc_sink.write_jdbc(generate.user_rows(spark, a.rows), options)
    else:
        landed = spark.read.format(a.format).schema(a.schema).load(a.input)
        landed = landed.withColumn("id", F.col(a.id))
        result = audit.exactly_once(landed, generate.sequence(spark, a.expected)).first()
        print(" ".join(f"{name}={value}" for name, value in result.asDict().items()))
        if a.per:
            audit.rows_per(landed, a.per).show()
        return int(any(result[name] for name in ("duplicates", "missing", "unexpected")))
    return 0
