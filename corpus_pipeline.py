"""From raw documents to training sequences: each stage takes what the one before it kept, written as Parquet.

All stages keep null and empty texts (as they are), very long ones (read whole), repeated rows and ids, and columns of any name; all
but the last return the columns they were given. Exact copies, empty texts among them, are near copies: one stays. An empty
table gives an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, neardup, packing, pii, toxicity
from millrace.llm.common import table
from millrace.session import delete_written, scratch_dir

TOXIC = 0.7
#: Rows that a task hands to Python at a time: a batch of long texts, its copies and what is made of it fill a worker's memory.
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 250


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage begins when the one before it is stored, so it deletes what that one has written on its way.

    Whole texts go to Python in batches of ``ROWS`` rows, unless the session says otherwise than Spark does by default.
    """

    @functools.wraps(work)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_written(spark, but_for=docs)
        if spark.conf.get(BATCH) == "10000":
            spark.conf.set(BATCH, ROWS)
        return work(spark, docs, sf_dir)

    return begun


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go; the net learns from the labels of the documents given."""
    net, name = toxicity.learned(docs, table(spark, sf_dir, "labels")), unused(docs, "toxicity")
    return toxicity.with_toxicity(docs, net, name).where(F.col(name) < TOXIC).drop(name)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return neardup.one_of_each(docs)


@stage
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark passage go."""
    name = unused(docs, "passages")
    found = decontaminate.with_passages(docs, table(spark, sf_dir, "benchmark"), name=name)
    return found.where(F.size(f"{name}.item_ids") == 0).drop(name)


@stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays, and its length, where there is one, is counted anew."""
    kept = pii.redacted(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", redact),
    ("packing", pack),
]

#: SQL expresses neither the trained net nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's output is stored before the next begins, which then deletes what lies behind."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        kept = work(spark, docs, sf_dir)
        path = scratch_dir(spark, f"stage_{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
