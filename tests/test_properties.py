"""Random inputs against a few lines of plain Python."""

from collections import Counter
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import keys, text
from millrace.operators import audit, outbox, windows
from millrace.sources import files

common = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.integers(-20, 20)


@common
@given(st.lists(st.integers(-(10**15), 10**16), min_size=1, max_size=50), st.sampled_from([5, 10, 60]))
def test_windows_hold_their_records(spark, micros, seconds):
    df = spark.createDataFrame([(m,) for m in micros], "m long").withColumn("t", F.timestamp_micros("m"))
    starts = windows.with_window(df, f"{seconds} seconds", "t").select("m", F.unix_micros("window_start").alias("w"))
    for r in starts.collect():
        assert r.w <= r.m < r.w + seconds * 1_000_000 and r.w % (seconds * 1_000_000) == 0


@common
@given(st.lists(st.integers(0, 4 * 10**9), min_size=1, max_size=50))
def test_window_labels_are_utc(spark, instants):
    df = spark.createDataFrame([(s,) for s in instants], "s long").withColumn("t", F.timestamp_seconds("s"))
    for r in windows.with_window_label(df, "10 seconds", "t").select("s", "window_start").collect():
        at = datetime.fromtimestamp(r.s - r.s % 10, timezone.utc)
        assert r.window_start == at.strftime("%Y-%m-%dT%H-%M-%S")


@common
@given(st.lists(small, max_size=60), st.lists(small, max_size=60))
def test_audit_counts(spark, landed, expected):
    def frame(values):
        return spark.createDataFrame([(v,) for v in values], "id int")

    left, right = Counter(landed), Counter(expected)
    assert audit.exactly_once(frame(landed), frame(expected)).first().asDict() == {
        "total": len(landed),
        "distinct_ids": len(left),
        "duplicates": len(landed) - len(left),
        "missing": len(right.keys() - left.keys()),
        "unexpected": len(left.keys() - right.keys()),
    }
    diff = {(r.side, r.id): r.copies for r in audit.multiset_diff(frame(expected), frame(landed)).collect()}
    assert diff == {("missing", k): n for k, n in (right - left).items()} | {
        ("extra", k): n for k, n in (left - right).items()
    }


@common
@given(st.lists(st.tuples(st.integers(0, 2), small), min_size=1, max_size=80), st.integers(1, 9), st.integers(1, 9), st.integers(1, 9))
def test_outbox_numbers(spark, pairs, cut_at, few, block):
    df = spark.createDataFrame(pairs, "g int, v int")
    got = outbox.number_in_groups(df, "g", "v", "n", cut_at, few, block).collect()
    expected = [(g, v, n) for g in range(3) for n, v in enumerate(sorted(v for h, v in pairs if h == g))]
    assert sorted(tuple(r) for r in got) == expected


@common
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\r\n\x85  ")), min_size=1, max_size=40))
def test_lines_are_cut_at_the_first_delimiter(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    cut = files.keyed_lines(df.select("value"))
    got = [(k and bytes(k).decode(), bytes(v).decode()) for k, v in cut.collect()]
    for (key, value), line in zip(got, lines):
        head, found, tail = line.partition(":")
        assert (key or "", value) == ((head, tail) if found else ("", line))


@common
@given(st.lists(st.binary(max_size=12), min_size=1, max_size=50))
def test_any_bytes_become_text(spark, blobs):
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "b binary")
    assert [r[0] for r in df.select(text.utf8("b")).collect()] == [b.decode("utf-8", "replace") for b in blobs]


@common
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=50), st.integers(1, 50))
def test_buckets_have_the_sign_of_the_number(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.select(keys.bucket("v", n)).collect()]
    assert got == [(abs(v) % n) * (1 if v >= 0 else -1) for v in values]
