"""Audits that go on from intervals, against the audit that reads everything."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import audit, intervals

SCHEMA = "shard string, id long"
EDGES = [-(2**63), 2**63 - 1, -1, 0, intervals.BLOCK - 1, intervals.BLOCK, -intervals.BLOCK]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


IDS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 30), st.sampled_from(EDGES))), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(IDS, IDS, IDS, st.sampled_from([(), ("shard",)]))
def test_same_row_as_the_whole_audit(spark, one, two, expected, by):
    state = intervals.added(intervals.of_ids(frame(spark, one), by=by), intervals.of_ids(frame(spark, two), by=by), by)
    got = intervals.exactly_once(state, intervals.of_ids(frame(spark, expected), by=by), by)
    assert as_rows(got) == as_rows(audit.exactly_once(frame(spark, one + two), frame(spark, expected), by=by))


def test_sequences_take_one_row_a_block(spark):
    ids = spark.range(10, 2 * intervals.BLOCK + 10)
    state = intervals.of_ids(ids)
    assert as_rows(state) == sorted(
        [(10, intervals.BLOCK - 1, 1), (intervals.BLOCK, 2 * intervals.BLOCK - 1, 1), (2 * intervals.BLOCK, 2 * intervals.BLOCK + 9, 1)], key=str
    )
    ranges = spark.createDataFrame([(10, 2 * intervals.BLOCK + 9), (7, 6)], "first long, last long")
    assert as_rows(intervals.of_ranges(ranges)) == as_rows(state)
    overlapping = spark.createDataFrame([(0, 9), (5, 14)], "first long, last long")
    assert as_rows(intervals.of_ranges(overlapping)) == [(0, 4, 1), (10, 14, 1), (5, 9, 2)]


def test_neighbours_meet(spark):
    state = intervals.added(intervals.of_ids(spark.range(0, 5)), intervals.of_ids(spark.range(5, 9)))
    assert as_rows(state) == [(0, 8, 1)]
    assert as_rows(intervals.added(state, intervals.of_ids(spark.range(2, 4)))) == [(0, 1, 1), (2, 3, 2), (4, 8, 1)]


def test_batches_are_counted_once_and_read_once(spark, tmp_path):
    path, log = str(tmp_path / "state"), str(tmp_path / "log")
    for batch in range(3):
        spark.range(batch * 100, batch * 100 + 100).write.parquet(f"{log}/{batch}")
        for _ in range(2):  # a batch that comes again
            state = intervals.store(spark, path, spark.read.parquet(f"{log}/{batch}"), batch)
    assert as_rows(state) == [(0, 299, 1)]
    assert all("/state/batch=2/" in f for f in state.inputFiles())
    with pytest.raises(ValueError, match="no state before"):
        intervals.store(spark, path, spark.range(3), 9)


def test_empty(spark):
    nothing = intervals.of_ids(spark.range(0))
    assert as_rows(intervals.exactly_once(nothing, nothing)) == [(0, 0, 0, 0, 0)]
    assert as_rows(intervals.exactly_once(nothing, intervals.of_ids(spark.range(3)))) == [(0, 0, 0, 3, 0)]
