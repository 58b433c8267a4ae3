"""Record keys, buckets and shard assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import zero_padded


def bucket(value: Column | str, n: int) -> Column:
    """Remainder with the sign of the dividend, so -3 in two buckets is -1."""
    value = F.col(value) if isinstance(value, str) else value
    return value % n


def long_key(value: Column | str) -> Column:
    """A long as eight big-endian bytes."""
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def partition_key(kind: str = "uuid", seed_from: Column | str | None = None, seed: int = 0) -> Column:
    """A key that spreads records over shards.

    ``uuid`` and ``random`` differ on every evaluation. ``hash`` depends only on
    ``seed_from``, so a retried task writes the same key again.
    """
    if kind == "uuid":
        return F.expr("uuid()")
    if kind == "random":
        return F.rand().cast("string")
    if kind == "hash":
        if seed_from is None:
            raise ValueError("a hash key needs seed_from")
        seed_from = F.col(seed_from) if isinstance(seed_from, str) else seed_from
        return F.md5(F.concat_ws(":", F.lit(seed), seed_from.cast("string")))
    raise ValueError(f"unknown partition key kind {kind!r}")


def shard_index(key: Column | str, n_shards: int) -> Column:
    """The shard whose share of the 128-bit MD5 key space holds the key; shares are equal and in order.

    The digest times ``n_shards``, without its lowest 128 bits: multiplied 32 bits at a time, lowest first.
    """
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(key.cast("binary"))
    index = F.lit(0).cast("bigint")
    for at in (25, 17, 9, 1):
        word = F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
        index = F.shiftright(word * n_shards + index, 32)
    return index.cast("int")


def shard_name(index: Column) -> Column:
    return F.concat(F.lit("shard-"), zero_padded(index, 3))
