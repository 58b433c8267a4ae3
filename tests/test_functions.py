import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import keys, text, times
from millrace.operators import envelope
from millrace.sources import generate


def column(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], f"c {ddl}")
    return [r[0] for r in df.select(expr).collect()]


def test_user_rows_and_their_schema(spark):
    df = generate.user_rows(spark, 2)
    assert [tuple(r) for r in df.collect()] == [(0, "user-name-000000000"), (1, "user-name-000000001")]
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.USER_ROW]
    assert df.schema["id"].nullable is False


def test_ids_beyond_nine_digits_are_not_cut(spark):
    assert column(spark, [12345678901], "long", text.user_name("c")) == ["user-name-12345678901"]


def test_zero_padding_is_that_of_a_format(spark):
    values = [0, 7, 999, 1000, -1, -99, -100, 2**63 - 1, -(2**63), None]
    expected = ["%03d" % v if v is not None else None for v in values]
    assert column(spark, values, "long", text.zero_padded("c", 3)) == expected
    assert column(spark, values[:-1], "long", text.zero_padded("c", 20)) == ["%020d" % v for v in values[:-1]]


def test_bad_utf8_is_replaced_and_null_gets_a_default(spark):
    values = [b"ok", b"\xffA", b"\xe2\x82", b"a\xf0\x9f\x98", "café \U0001f600".encode(), b"", None]
    expected = [v.decode("utf-8", "replace") if v is not None else None for v in values]
    blobs = [bytearray(v) if v is not None else None for v in values]
    assert column(spark, blobs, "binary", text.utf8("c")) == expected
    assert column(spark, blobs, "binary", text.value_text("c"))[-1] == "<no-val>"
    assert column(spark, blobs, "binary", text.key_text("c"))[-1] == "<no-key>"


def test_json_text(spark):
    cases = {
        '{"day":"2023-04-10","id":1}': ("2023-04-10", 1),
        '{"id":7}': (None, 7),
        "bad": (None, None),
        '{"day":1,"id":"x"}': ("1", None),
        "": None,
        None: None,
    }
    got = column(spark, cases, "string", text.from_json_text("c", schemas.DAY_PAYLOAD))
    assert [tuple(r) if r is not None else None for r in got] == list(cases.values())


def test_produced_records(spark):
    got = envelope.produced_records(generate.sequence(spark, 23), "raw").collect()
    for i, r in enumerate(got):
        assert (r.topic, bytes(r.key), bytes(r.value).decode()) == ("raw", struct.pack(">q", i % 11), '{"id": %d}' % i)


def test_bucket_keeps_the_sign(spark):
    assert column(spark, [-3, -2, 3, 12], "long", keys.bucket("c", 2)) == [-1, 0, 1, 0]


def test_long_key_of_negative_numbers(spark):
    got = column(spark, [-1, 2**40], "long", keys.long_key("c"))
    assert [bytes(b) for b in got] == [struct.pack(">q", -1), struct.pack(">q", 2**40)]


def test_partition_keys(spark):
    ids = spark.range(1000)
    for kind in ("uuid", "random"):
        assert ids.select(keys.partition_key(kind).alias("k")).distinct().count() == 1000
    hashed = ids.select(keys.partition_key("hash", "id", seed=3).alias("k"))
    assert [r.k for r in hashed.collect()] == [hashlib.md5(f"3:{i}".encode()).hexdigest() for i in range(1000)]
    with pytest.raises(ValueError):
        keys.partition_key("hash")
    with pytest.raises(ValueError):
        keys.partition_key("other")


def test_shards_split_the_key_space_evenly(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    for n in (1, 3, 4, 1000, 2**31 - 1):
        got = ids.select("k", keys.shard_index("k", n).alias("s"))
        for r in got.collect():
            assert r.s == int(hashlib.md5(r.k.encode()).hexdigest(), 16) * n >> 128
    counts = ids.groupBy(keys.shard_index("k", 4)).count().collect()
    assert len(counts) == 4 and min(r["count"] for r in counts) > 900


def test_random_key_decides_the_shard_written_beside_it(spark):
    records = envelope.to_shards(envelope.log_events(spark.range(500)), "s", sequence_number=F.lit("1"), n_shards=8)
    wrong = records.where(F.col("shard_id") != keys.shard_name(keys.shard_index("partition_key", 8)))
    assert wrong.count() == 0 and records.select("shard_id").distinct().count() == 8


def test_branches_are_tried_in_order_and_null_matches_none(spark):
    size = F.when(F.col("c") < 10, "small").when(F.col("c") < 100, "medium").when(F.col("c") >= 100, "large")
    assert column(spark, [3, 10, 99, 100, -7, None], "int", size) == ["small", "medium", "medium", "large", "small", None]
    assert column(spark, [3, None], "int", F.expr("case c when 3 then 'three' else 'other' end")) == ["three", "other"]


def test_times_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql("select timestamp_ntz'2024-03-10 02:30:05' as t").withColumn("i", times.instant("t"))
            got = df.select(F.unix_micros("i").alias("us"), times.utc_label("i").alias("label")).first()
            assert (got.us, got.label) == (1710037805000000, "2024-03-10T02-30-05")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
