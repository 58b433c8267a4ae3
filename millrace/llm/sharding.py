"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ranked, table
from millrace.session import written


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """One row per document with its shard and slot, every shard with the mixture of sources of the whole.

    Rows of a source are shuffled by a seeded hash and ranked; the fractional rank ``(rank + 1/2) / rows`` sorts
    all sources into one another, and the sorted rows are cut into ``shards`` parts whose counts differ by one at
    most (law ``rows``). Null source is a source of its own; null text has size 1 and checksum 0. Rows alike in
    every respect each take a place. Further columns of the input are left out; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    base = written(base.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32")), "shard_rows")
    buckets = max(1024, base.count() // 20_000)
    order = ["_h", "doc_id", "text_crc32", "size"]
    first = ranked(base, ["_source"], F.pmod("_h", F.lit(buckets)), order, "_rank")
    first = written(first.withColumn("_part", (F.col("_rank") + 0.5) / F.col("_rank_of")), "shard_ranks")
    placed = ranked(first, [], F.floor(F.col("_part") * buckets), ["_part", "_source", *order], "_place")
    placed = placed.withColumn("shard", F.expr(f"cast(_place * {shards} div _place_of as int)"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"_place - (shard * _place_of + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sharding(spark, sf_dir):
    return interleaved_shards(table(spark, sf_dir, "documents"))
