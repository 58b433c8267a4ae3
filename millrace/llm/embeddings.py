"""Near duplicates of vectors: spherical k-means cells, blocked cosine products within cells."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, table
from millrace.session import written


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; divided by the largest entry first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_means(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = sample[draw.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def _closed(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index joined to each of ``n`` by the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(vectors: DataFrame, least: float = 0.95, probes: int = 4, per_cell: int = 400, block: int = 1024, sample: int = 20_000) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every vector.

    Equal vectors meet first and are compared once. Centres are fitted on at most ``sample`` different vectors (by
    order of a hash); every vector goes to its ``probes`` nearest cells and is compared with the vectors whose nearest
    cell is one of these. A large cell is cut into blocks of about ``block`` rows, and each pair of blocks is one group.
    A group gives counts and the links of its closure, not its pairs. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing, nor do vectors of different lengths with each other.
    Rows with one vec_id count as several vectors; a null vec_id stays null. The label is not read.
    """
    spark = vectors.sparkSession
    fine = "embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(embedding, x -> x <> 0)"
    rows = written(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("ok", F.expr(fine)), "vectors")
    reps = rows.where("ok").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "different")
    widest = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if widest:
        dim, count = widest[0]
        some = reps.where(F.col("dim") == dim).select("embedding", F.xxhash64(F.lit(5), "embedding").alias("_h")).orderBy("_h").limit(sample).collect()
        centres = spherical_means(unit(np.array([r[0] for r in some])), int(min(4096, max(1, count // per_cell), len(some))))
    else:
        dim, centres = 0, np.zeros((1, 0))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shared.value
        many = min(probes, len(centres))
        for batch in batches:
            near: list = [[-int(d)] for d in batch["dim"]]
            own = np.flatnonzero(batch["dim"].to_numpy() == dim)
            if len(own):
                likeness = unit(np.stack(batch["embedding"].to_numpy()[own])) @ centres.T
                top = np.argsort(-likeness, axis=1, kind="stable")[:, :many]
                for k, t in zip(own, top.tolist(), strict=True):
                    near[k] = t
            yield batch.assign(near=near)[["rep", "n", "embedding", "near"]]

    assigned = written(reps.select("rep", "n", "embedding", "dim").mapInPandas(assign, "rep long, n long, embedding array<double>, near array<int>"), "cells")
    at = assigned.withColumn("cell", F.explode("near"))
    sizes = at.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    at = at.join(F.broadcast(sizes) if len(centres) <= 4096 else sizes, "cell").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    at = at.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    at = at.withColumn("b1", F.least("own", "other")).withColumn("b2", F.greatest("own", "other"))

    def compare(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        cell, b1, b2 = key
        x = unit(np.stack(group["embedding"].to_numpy()))
        near, rep, n, own = group["near"].tolist(), group["rep"].to_numpy(), group["n"].to_numpy(), group["own"].to_numpy()
        left = np.flatnonzero(own == b1)
        right = left if b1 == b2 else np.flatnonzero(own == b2)
        home = np.array([v[0] == cell for v in near])
        found = []
        for s in range(0, len(left), block):
            a, b = np.nonzero(x[left[s : s + block]] @ x[right].T >= least)
            found.append(np.stack([left[s + a], right[b]]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        keep = (home[a] | home[b]) & ((a < b) if b1 == b2 else np.ones(len(a), bool))
        a, b = a[keep], b[keep]
        # A pair with two homes can meet in both: it counts in the smaller of those cells.
        mixed = np.flatnonzero(home[a] != home[b])
        drop = [k for k in mixed for i, j in [(a[k], b[k]) if home[a[k]] else (b[k], a[k])] if near[j][0] in near[i] and near[j][0] < cell]
        a, b = np.delete(a, drop), np.delete(b, drop)
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        head = rep[_closed(len(rep), a, b)]
        out = pd.DataFrame({"rep": rep, "links": links, "head": head})
        return out[links > 0]

    found = written(at.groupBy("cell", "b1", "b2").applyInPandas(compare, "rep long, links long, head long"), "found")
    heads = components(found.select(F.col("rep").alias("a"), F.col("head").alias("b"))).withColumnsRenamed({"id": "rep"})
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = reps.select("rep", "embedding", "first", "n").join(links, "rep", "left").join(heads, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    known = written(known, "known")
    names = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(names, "component").select("embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("ok").join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_embeddings(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: The same in SQL, by all pairs.
SQL = """with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
fine as (
  select vec_id, list_transform(v.e, lambda c: coalesce(c, 0.0)) as e from v where v.e is not null and len(v.e) > 0
    and len(list_filter(v.e, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(v.e, lambda c: c <> 0)) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from fine x join fine y
  on x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.95),
reached as (
  select vec_id as a, vec_id as b from v
  union
  select r.a, l.b from reached r join links l on l.a = r.b)
select r.a as vec_id, (select count(*) from links l where l.a = r.a) as n_links, min(r.b) as component_id,
  r.a = min(r.b) as kept
from reached r group by r.a"""
