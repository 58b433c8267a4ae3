"""Sending an outbox of messages through a caller's client."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import DataFrame, Row


def send(messages: DataFrame, connect: Callable[[], Callable[[list[Row]], None]], batched: bool = True) -> None:
    """Send every message of an outbox: batch by batch as they are numbered, or singly.

    ``connect`` runs once per partition and returns the function that sends a list. No more
    than one batch is held at a time. A retried task sends its messages again, in the same
    batches and with the same message ids.
    """
    if batched:
        messages = messages.repartition("bucket", "batch_no").sortWithinPartitions("bucket", "batch_no", "message_id")

    def send_partition(rows: Iterable[Row]) -> None:
        batches = groupby(rows, lambda row: (row.bucket, row.batch_no)) if batched else ((None, [row]) for row in rows)
        send_list = None
        for _, batch in batches:
            send_list = send_list or connect()
            send_list(list(batch))

    messages.foreachPartition(send_partition)
