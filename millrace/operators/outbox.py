"""Queue messages in numbered batches, as a table that a sender works through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text

# Fixed value: the most messages that a queue service takes in one batch.
BATCH_SIZE = 10

# Rows in one range, and ranges at most; copies of an id that are written out where they were
# counted; and copies in one block of an id that has more.
ROWS = 100_000
RANGES = 4_096
FEW = 1_000
BLOCK = 100_000


def _expanded(first: str, copies: str, out: str) -> Column:
    return F.explode(F.expr(f"sequence({first}, {first} + {copies} - 1)")).alias(out)


def splitters(df: DataFrame, order_by: str, rows: int = ROWS) -> list[int]:
    """Values that cut a column into ranges of about ``rows`` rows each, from a sketch of its quantiles.

    Ranges follow the rows and not the distance between values: ids that lie close together are cut as finely as others.
    There are never fewer ranges than Spark has tasks after a shuffle, nor more than :data:`RANGES`, each then longer.
    """
    n = df.agg(F.count(order_by)).first()[0]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(RANGES, max(-(-n // rows), min(8 * tasks, n)))
    if ranges < 2:
        return []
    shares = F.array(*(F.lit(k / ranges) for k in range(1, ranges)))
    return sorted(set(df.agg(F.percentile_approx(order_by, shares, F.lit(20 * ranges))).first()[0]))


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are no larger than the value, by halving."""
    if not cuts:
        return F.lit(0)
    of = F.array(*map(F.lit, cuts))
    steps = F.array(*(F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)))
    # Beyond the end there is no cut, which is null and not below the value.
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(of, at + step - 1) <= value, at + step).otherwise(at))


def number_in_groups(
    df: DataFrame,
    group: str,
    order_by: str,
    out: str = "n",
    rows: int = ROWS,
    few: int = FEW,
    block: int = BLOCK,
    unique: bool = False,
) -> DataFrame:
    """(group, order_by, n): each group's rows numbered 0, 1, 2, ... by an integer column.

    A group may hold most of the table, and so may copies of one value, so neither is ever
    brought together. Copies are counted before the shuffle. Groups are cut into ranges of
    about ``rows`` rows (see :func:`splitters`, two passes over the column), which are numbered
    independently and then moved up by the rows in the ranges before them; only those sums, one
    row per range, are brought together per group. Values with more than a ``few`` copies are written out again in blocks, which are spread
    over tasks. A null in either column fails the job.

    ``unique`` says that no value occurs twice in its group, as offsets do not, and saves
    the counting of copies. The numbers are right either way; only the work differs.
    """
    given = [
        F.coalesce(name, F.raise_error(F.lit(f"a row to number has no {name}"))).alias(name)
        for name in (group, order_by)
    ]
    # Never null, so that no filter makes the plan's uses of these counts differ: they share one shuffle.
    cuts = splitters(df, order_by, rows)
    ranged = df.select(*given).withColumn("__range", F.coalesce(_range_of(F.col(order_by), cuts), F.lit(0)))
    if unique:
        counted = ranged.withColumn("__copies", F.lit(1))
    else:
        counted = ranged.groupBy(group, "__range", order_by).agg(F.count("*").alias("__copies"))

    def rows_before(count: str, window: Window) -> Column:
        return F.coalesce(F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    starts = (
        counted.groupBy(group, "__range")
        .agg(F.sum("__copies").alias("__rows"))
        .select(group, "__range", rows_before("__rows", Window.partitionBy(group).orderBy("__range")).alias("__start"))
    )
    placed = (
        counted.withColumn("__at", rows_before("__copies", Window.partitionBy(group, "__range").orderBy(order_by)))
        .join(starts, [group, "__range"])
        .select(group, order_by, "__copies", (F.col("__start") + F.col("__at")).alias("__first"))
    )
    if unique:
        return placed.select(group, order_by, F.col("__first").alias(out))
    in_place = placed.where(F.col("__copies") <= few)
    blocks = (
        placed.where(F.col("__copies") > few)
        .withColumn("__block", F.explode(F.expr(f"sequence(0L, (__copies - 1) div {block})")))
        .repartition(group, order_by, "__block")
        .withColumns(
            {
                "__first": F.col("__first") + F.col("__block") * block,
                "__copies": F.least(F.lit(block), F.col("__copies") - F.col("__block") * block),
            }
        )
    )
    written_out = (group, order_by, _expanded("__first", "__copies", out))
    return in_place.select(*written_out).unionByName(blocks.select(*written_out))


def to_messages(
    df: DataFrame,
    id_col: str,
    bucket: str,
    batch_size: int = BATCH_SIZE,
    rows: int = ROWS,
    unique: bool = False,
) -> DataFrame:
    """Messages (bucket, batch_no, message_id, body), at most ``batch_size`` to a batch.

    The message id, which names the bucket and the place in it, lets a receiver discard what
    a retried sender sends again. ``unique`` says that ids occur once in their bucket.
    """
    numbered = number_in_groups(df, bucket, id_col, "__n", rows, unique=unique)
    return numbered.select(
        F.col(bucket).alias("bucket"),
        F.expr(f"__n div {batch_size}").alias("batch_no"),
        F.concat_ws("-", F.col(bucket).cast("string"), F.col("__n").cast("string")).alias("message_id"),
        text.message_body(id_col).alias("body"),
    )
