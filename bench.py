"""Time every registered query, and the codec over a larger generated table.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed runs after one warm-up; the median of them counts. A query that has
used up ``BENCH_SECONDS`` is not run again. Streams that end in an audit report it.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import keys
from millrace.operators import audit, envelope
from millrace.plans.queries import QUERIES
from millrace.session import local_session
from millrace.sources import generate

LARGE = 10_000_000
AUDIT_COLUMNS = ["total", "distinct_ids", "duplicates", "missing", "unexpected"]


def large_codec(spark: SparkSession, sf_dir: str, rows: int = LARGE) -> DataFrame:
    """Ids encoded, wrapped, decoded and counted per shard."""
    records = envelope.to_shards(
        envelope.log_events(generate.sequence(spark, rows)),
        "generated",
        partition_key=F.lit("k"),
        sequence_number=F.col("id"),
        shard_id=keys.shard_name(F.col("id") % 16),
    )
    events = envelope.consumed_events(records)
    return events.groupBy("shard_id").agg(F.count("*").alias("n"), F.max("id").alias("last_id"))


def large_audit(spark: SparkSession, sf_dir: str, rows: int = LARGE) -> DataFrame:
    ids = generate.sequence(spark, rows)
    return audit.exactly_once(ids, ids)


def timed_run(run: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str):
    begun = time.perf_counter()
    result = run(spark, sf_dir)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun, result


def median_seconds(run, spark: SparkSession, sf_dir: str, runs: int) -> tuple[float, DataFrame]:
    _, result = timed_run(run, spark, sf_dir)
    taken = []
    while len(taken) < runs:
        took, result = timed_run(run, spark, sf_dir)
        taken.append(took)
    return statistics.median(taken), result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("OFF")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timed, rows, audits = {}, {}, {}
    for name, run in (QUERIES | {"large_codec": large_codec, "large_audit": large_audit}).items():
        median, result = median_seconds(run, spark, sf_dir, runs)
        timed[name] = round(median, 4)
        if name.startswith("stream_") and set(AUDIT_COLUMNS) <= set(result.columns):
            sums = result.agg(*(F.sum(c).alias(c) for c in AUDIT_COLUMNS)).first()
            audits[name] = sums.asDict()
        rows[name] = LARGE if name.startswith("large_") else events
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "input_rows_per_sec": {name: round(rows[name] / max(t, 1e-4)) for name, t in timed.items()},
                "audits": audits,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
                "cpus": cpus,
                "spark": pyspark.__version__,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
