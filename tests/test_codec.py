import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import codec
from millrace.operators import envelope

MAX, MIN = 2**63 - 1, -(2**63)

# Payloads and the ids they hold.
PAYLOADS = {
    "00": 0,
    "01": -1,
    "02": 1,
    "7E": 63,
    "8001": 64,
    "D804": 300,
    "FEFFFFFFFFFFFFFFFF01": MAX,
    "FFFFFFFFFFFFFFFFFF01": MIN,
}


def varint_hex(value: int) -> str:
    """Zig-zag varint, spelled out a byte at a time."""
    zigzag = 2 * value if value >= 0 else -2 * value - 1
    out = bytearray()
    while True:
        zigzag, low = zigzag >> 7, zigzag & 0x7F
        out.append(low | (0x80 if zigzag else 0))
        if not zigzag:
            return out.hex().upper()


def encoded(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "id long")
    return codec.encode_long(df, "id")


def decoded(spark, payloads, mode="PERMISSIVE"):
    df = spark.createDataFrame([(bytearray.fromhex(p) if p is not None else None,) for p in payloads], "data binary")
    return [r.id for r in codec.decode_long(df, "data", mode=mode).collect()]


def test_known_payloads(spark):
    assert decoded(spark, PAYLOADS, "FAILFAST") == list(PAYLOADS.values())
    got = encoded(spark, PAYLOADS.values()).select(F.hex("data")).collect()
    assert [r[0] for r in got] == list(PAYLOADS)


def test_bytes_after_the_record_are_ignored(spark):
    assert decoded(spark, ["D804FF", "00FF", "D804FFFFFFFFFFFFFFFFFFFF", "FEFFFFFFFFFFFFFFFF01FF"]) == [300, 0, 300, MAX]


BROKEN = ["", "80", "80" * 8, "80" * 9, "80" * 10, "80" * 11, None]


def test_broken_payloads_become_null_when_permissive(spark):
    assert decoded(spark, BROKEN + ["02"]) == [None] * len(BROKEN) + [1]


@pytest.mark.parametrize("payload", BROKEN)
def test_broken_payload_fails_by_default(spark, payload):
    with pytest.raises(PySparkException, match="varint"):
        decoded(spark, [payload], "FAILFAST")


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        decoded(spark, ["00"], "IGNORE")


def test_round_trip_around_every_length(spark):
    edges = {0, MAX, MIN}
    for bits in range(1, 63):
        edges |= {s * (2**bits) + d for s in (1, -1) for d in (-1, 0, 1)}
    rng = random.Random(7)
    values = sorted(edges) + [rng.randrange(MIN, MAX + 1) >> rng.randrange(64) for _ in range(5000)]
    df = encoded(spark, values).withColumnRenamed("id", "sent")
    got = codec.decode_long(df, "data", "id").select("sent", "id", F.hex("data").alias("hex")).collect()
    assert all(r.sent == r.id and r.hex == varint_hex(r.sent) for r in got) and len(got) == len(values)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(MIN, MAX), min_size=1, max_size=200), st.binary(max_size=4))
def test_any_longs_with_any_tail(spark, values, tail):
    df = encoded(spark, values).select(
        F.col("id").alias("sent"), F.concat("data", F.lit(bytearray(tail))).alias("data")
    )
    got = codec.decode_long(df, "data").collect()
    assert [r.id for r in got] == [r.sent for r in got] == values


def test_events_through_the_shard_envelope(spark, rows):
    ids = spark.createDataFrame([(0,), (1,), (2,)], "id long")
    records = envelope.to_shards(
        envelope.log_events(ids),
        "stream-01",
        partition_key=F.lit("abc"),
        sequence_number=F.lit("99"),
        shard_id=F.lit("shard-000"),
    )
    first = records.first()
    assert (first.partition_key, first.sequence_number, first.stream_name) == ("abc", "99", "stream-01")
    assert first.approximate_arrival_timestamp is not None and first.sub_sequence_number == 0
    assert rows(envelope.consumed_events(records)) == [(0, "shard-000"), (1, "shard-000"), (2, "shard-000")]
    assert [bytes(r.data).hex() for r in envelope.payloads(records).collect()] == ["00", "02", "04"]


def test_existing_id_column_is_replaced(spark):
    df = encoded(spark, [5]).withColumn("id", F.lit("old"))
    assert codec.decode_long(df, "data").first().id == 5
