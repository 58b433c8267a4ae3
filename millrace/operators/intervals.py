"""Landed ids as intervals, so that an audit goes on from what it knows and reads new records only.

A state is a table of ``(*by, first, last, copies)``: every id from ``first`` to ``last`` landed ``copies`` times. Ids that come
in sequence take a row for each run of them, however many there are. Intervals end at multiples of ``BLOCK``, so that all work is
done by block of ids: a shard with a third of all ids is as many groups as it has blocks, and no group holds more than ``BLOCK`` ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import path_exists

_BITS = 20
#: Ids of a block.
BLOCK = 1 << _BITS


def of_ids(df: DataFrame, id_col: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """The state of records. Copies are summed before the shuffle; null ids share a row with null bounds."""
    per_id = df.groupBy(*by, F.col(id_col).cast("long").alias("first")).agg(F.count("*").alias("copies"))
    return _merged(per_id.withColumn("last", F.col("first")), by, ["copies"])


def of_ranges(ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The state of ranges ``(*by, first, last)`` in which every id stands once; ranges may overlap, and empty ones are left out."""
    block = F.explode(F.sequence(F.shiftright("first", _BITS), F.shiftright("last", _BITS))).alias("_block")
    cut = ranges.where("first <= last").select(*by, "first", "last", block)
    begin = F.shiftleft(F.col("_block"), _BITS)
    cut = cut.select(
        *by, F.greatest("first", begin).alias("first"), F.least("last", begin + F.lit(BLOCK - 1)).alias("last"), F.lit(1).cast("long").alias("copies")
    )
    return _merged(cut, by, ["copies"])


def added(state: DataFrame, more: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Both states as one."""
    return _merged(state.unionByName(more), by, ["copies"])


def exactly_once(landed: DataFrame, expected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The row of :func:`millrace.operators.audit.exactly_once`, from two states."""
    none = F.lit(0).cast("long")
    marks = landed.withColumn("landed", F.col("copies")).withColumn("expected", none).unionByName(
        expected.withColumn("landed", none).withColumn("expected", F.col("copies"))
    )
    runs = _runs(marks.drop("copies"), by, ["landed", "expected"])
    was_landed, was_expected, ids = F.col("landed") > 0, F.col("expected") > 0, F.col("_ids")

    def total(where, value=ids):
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    return runs.groupBy(*by).agg(
        total(was_landed, ids * F.col("landed")).alias("total"),
        total(was_landed).alias("distinct_ids"),
        total(was_landed, ids * (F.col("landed") - 1)).alias("duplicates"),
        total(was_expected & ~was_landed).alias("missing"),
        total(was_landed & ~was_expected).alias("unexpected"),
    )


def store(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, id_col: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """The state with one more batch, for ``foreachBatch``; only that batch's records and the state before it are read.

    Each batch's state is a folder of its number. A batch that comes again replaces its own folder, so nothing is counted
    twice. The state before the one just read may be deleted.
    """
    state = of_ids(batch, id_col, by)
    before = f"{path}/batch={batch_id - 1}"
    if path_exists(spark, before):
        state = added(spark.read.schema(state.schema).parquet(before), state, by)
    elif batch_id > 0:
        raise ValueError(f"batch {batch_id} has no state before it in {path}")
    now = f"{path}/batch={batch_id}"
    state.write.mode("overwrite").parquet(now)
    return spark.read.schema(state.schema).parquet(now)


def record(records: DataFrame, path: str, checkpoint: str, trigger: Mapping, id_col: str = "id", by: Sequence[str] = ()) -> StreamingQuery:
    """Keep the state of a stream, a folder for each batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        store(batch.sparkSession, path, batch, batch_id, id_col, by)

    return records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """The state after the last batch."""
    states = spark.read.parquet(path)
    return states.where(F.col("batch") == states.agg(F.max("batch")).first()[0]).drop("batch")


def _runs(marks: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``(*by, _block, _at, _ids, *measures)``: the longest runs of ids of a block whose measures, summed, are the same and not all 0."""
    inside = F.lit(BLOCK - 1)
    block = F.shiftright("first", _BITS).alias("_block")
    opened = marks.select(*by, block, F.col("first").bitwiseAND(inside).alias("_at"), *measures)
    closed = marks.where(F.col("first").isNotNull()).select(
        *by, block, (F.col("last").bitwiseAND(inside) + 1).alias("_at"), *((-F.col(m)).alias(m) for m in measures)
    )
    steps = opened.unionByName(closed).groupBy(*by, "_block", "_at").agg(*(F.sum(m).alias(m) for m in measures))
    not_zero = " or ".join(f"`{m}` <> 0" for m in measures)
    in_order = Window.partitionBy(*by, "_block").orderBy("_at")
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.where(not_zero).select(
        *by, "_block", "_at",
        # Null ids are one id.
        F.when(F.col("_at").isNull(), 1).otherwise(F.lead("_at").over(in_order) - F.col("_at")).cast("long").alias("_ids"),
        *(F.sum(m).over(running).alias(m) for m in measures),
    )
    return runs.where(not_zero)


def _merged(marks: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    first = F.shiftleft(F.col("_block"), _BITS) + F.col("_at")
    runs = _runs(marks, by, measures)
    return runs.select(*by, first.alias("first"), (first + (F.col("_ids") - 1)).alias("last"), *measures)
