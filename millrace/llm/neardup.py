"""SimHash near-duplicates by a grid join over segment bit counts."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, give_back, lower_ascii, table, trimmed
from millrace.llm.decontaminate import Hashes, shingles
from millrace.session import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = 0x5555555555555555
#: Cells with more members are linked through the values one bit away instead of pair by pair; no link is lost.
FEW = 24
#: Members of a cell that are compared with all others of it in the first turn; each turn takes eight times as many as all before, about.
TURN = 2
#: Bits of a hash by which shingles are counted, for their order only; buckets in one piece of the counts; and pieces
#: that are added up in one task are first summed in so many.
BUCKETS, PIECE, SALTS = 22, 1 << 16, 32
#: Bits of a hash by which a text's shingles are counted, for a bound on what two texts have in common.
CELLS = 9


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words."""
    words = [w.encode("utf-8", "surrogatepass") for w in WORD.findall(lower_ascii(text))]
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    one = xxhash.xxh64_intdigest
    return majority(np.fromiter((one(b" ".join(x), 42) for x in zip(*(words[k:] for k in range(width)), strict=False)), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` (a signed long) of the whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": fps})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` whose closure joins exactly the distinct fingerprints ``fp`` within 2 differing bits.

    A fingerprint is embedded as the bit counts of its 32 segments, each count (0 to 2) written as that many ones,
    so that Manhattan distance is the popcount of an exclusive or. It never exceeds the Hamming distance. Of five
    blocks of segments at most two can differ within the radius: points are joined in the grid cells of any three
    blocks, passed on if the bound allows, and verified on the fingerprints themselves.
    """
    if radius != 2:
        raise ValueError("the cells and the values between two fingerprints are made for a radius of 2")
    edges = [0, 12, 24, 36, 50, 64]
    blocks = [((1 << edges[k + 1]) - (1 << edges[k])) for k in range(5)]
    either = f"((fp | shiftrightunsigned(fp, 1)) & {LOW}L)"
    both = f"(fp & shiftrightunsigned(fp, 1) & {LOW}L)"
    points = fps.select("fp", F.expr(f"{either} | shiftleft({both}, 1)").alias("counts"))
    cells = F.array(*(
        F.struct(F.lit(j).alias("grid"), F.col("counts").bitwiseAND(F.lit(_signed(sum(blocks[b] for b in three)))).alias("cell"))
        for j, three in enumerate(combinations(range(5), 3))
    ))
    keyed = points.select("fp", "counts", F.explode(cells).alias("at")).select("fp", "counts", "at.grid", "at.cell")
    sizes = written(keyed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "cells")
    members = written(keyed.join(sizes, ["grid", "cell"]), "members")
    few = members.where(F.col("members") <= FEW)
    left = few.select("grid", "cell", F.col("fp").alias("a"), F.col("counts").alias("ca"))
    right = few.select("grid", "cell", F.col("fp").alias("b"), F.col("counts").alias("cb"))
    pairs = (
        left.join(right, ["grid", "cell"])
        .where("a < b").where(f"bit_count(ca ^ cb) <= {radius}").where(f"bit_count(a ^ b) <= {radius}")
        .select("a", "b")
    )
    # Two values differ in two bits or fewer exactly if some value lies within one bit of both.
    near = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)))
    spread = members.where(F.col("members") > FEW).select("fp").distinct().select("fp", F.explode(near).alias("between"))
    spread = spread.join(spread.groupBy("between").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1"), "between")
    return pairs.unionByName(spread.where("fp <> b").select(F.col("fp").alias("a"), "b"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` for every document.

    Equal fingerprints meet first, so copies are one point. Null and empty texts have fingerprint zero and are linked
    like any other; repeated rows come back as often as they came. A component without any doc_id has a null id.
    Columns besides doc_id and text are not read; an empty table gives no rows.
    """
    rows = written(with_fingerprint(docs, width), "fingerprints")
    firsts = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    joined = components(fingerprint_links(firsts.select("fp"))).withColumnsRenamed({"id": "fp", "component": "head"})
    heads = firsts.join(joined, "fp", "left").withColumn("head", F.coalesce("head", "fp"))
    heads = written(heads, "heads")
    ids = heads.groupBy("head").agg(F.min("first").alias("component_id"))
    labels = heads.join(ids, "head").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))



class Shingles:
    """The sorted different hashes of all runs of ``width`` words; a shorter text is one shingle, an empty one too."""

    def __init__(self, width: int = 5):
        self.width, self.hashes = width, Hashes(np.array([c != 32 and not 9 <= c <= 13 for c in range(256)]))

    def of(self, text: str | None) -> np.ndarray:
        words = self.hashes.of(text)
        return np.unique(shingles(words, min(self.width, len(words))))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKETS)).astype(np.int64)


def shingle_order(docs: DataFrame, width: int = 5) -> np.ndarray:
    """How often the shingles of each bucket of hashes occur; it orders shingles alike for all texts, seldom ones first.

    Each task counts into one array and hands it on in compressed pieces, which Spark adds up piece by piece; one array of
    fixed size reaches the driver, whatever the table's.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        of, total = Shingles(width).of, np.zeros(1 << BUCKETS, np.uint32)
        for batch in trimmed(batches):
            for text in batch["text"]:
                np.add.at(total, _bucket(of(text)), 1)
        pieces = total.reshape(-1, PIECE)
        salt = int(total[::1001].sum()) % SALTS
        yield pd.DataFrame([(k, salt, zlib.compress(x.tobytes(), 1)) for k, x in enumerate(pieces) if x.any()], columns=["piece", "salt", "counts"])

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PIECE, np.uint64)
        for x in group["counts"]:
            total += np.frombuffer(zlib.decompress(x), np.uint32)
        total = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        return pd.DataFrame({"piece": group["piece"][:1], "salt": 0, "counts": [zlib.compress(total.tobytes(), 1)]})

    shape = "piece int, salt int, counts binary"
    sums = docs.select("text").mapInPandas(count, shape).groupBy("piece", "salt").applyInPandas(added, shape)
    out = np.zeros((1 << BUCKETS) // PIECE * PIECE, np.uint32).reshape(-1, PIECE)
    for r in sums.groupBy("piece").applyInPandas(added, shape).collect():
        out[r["piece"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out.ravel()


def common_least(sizes: int | np.ndarray, least: float) -> int | np.ndarray:
    """The fewest shingles that two texts of so many in all have in common at that similarity."""
    return np.ceil(least / (1 + least) * sizes - 1e-9)


def with_prefixes(rows: DataFrame, least: float, width: int = 5) -> DataFrame:
    """``_row``, ``key`` (equal for equal sets of shingles), ``fp``, ``size``, ``prefix`` and ``spread``.

    ``fp`` is the fingerprint of the set of shingles (a signed long). Two sets of similarity ``least`` or more share one shingle of their prefixes at least, whatever the common order.
    ``spread`` counts the shingles by some bits of their hashes (null where a count passes 255): two texts have no more in
    common than the smaller counts come to.
    """
    shared = rows.sparkSession.sparkContext.broadcast(shingle_order(rows, width))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        of, often = Shingles(width).of, shared.value
        for batch in trimmed(batches):
            out = []
            for row, text in zip(batch["_row"], batch["text"], strict=True):
                h = of(text)
                first = h[np.lexsort((h, often[_bucket(h)]))[: len(h) - math.ceil(least * len(h) - 1e-9) + 1]]
                spread = np.bincount((h & np.uint64((1 << CELLS) - 1)).astype(np.int64), minlength=1 << CELLS)
                fits = spread.astype(np.uint8).tobytes() if spread.max() < 256 else None
                out.append((row, xxhash.xxh128_digest(h.tobytes()), _signed(majority(h)), len(h), first.view(np.int64), fits))
            yield pd.DataFrame(out, columns=["_row", "key", "fp", "size", "prefix", "spread"])

    return rows.select("_row", "text").mapInPandas(run, "_row long, key binary, fp long, size long, prefix array<long>, spread binary")


def _for_both(pairs: DataFrame, values: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """The pairs with the named columns of both rows, ``a_...`` and ``b_...``, and the table of these; only rows in a pair are shuffled."""
    needed = pairs.select(F.col("a").alias("_row")).unionByName(pairs.select(F.col("b").alias("_row"))).distinct()
    values = written(values.select("_row", *names).join(needed, "_row", "left_semi"), "values")
    for side in ("a", "b"):
        pairs = pairs.join(values.toDF(side, *(f"{side}_{name}" for name in names)), side)
    return pairs, values


def similar(pairs: DataFrame, prints: DataFrame, rows: DataFrame, least: float, width: int = 5) -> DataFrame:
    """The pairs of rows ``(a, b)``, a written table, whose texts have similarity ``least`` or more, exact over all their shingles.

    Pairs whose counts of shingles rule it out go first; only the texts of the others meet.
    """

    @F.pandas_udf("boolean")
    def possible(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a_size, b_size, a, b in trimmed(batches):
            out = np.ones(len(a), bool)
            known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
            if len(known):
                x, y = (np.frombuffer(b"".join(v.iloc[known]), np.uint8).reshape(-1, 1 << CELLS) for v in (a, b))
                most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                out[known] = most >= common_least((a_size + b_size).to_numpy()[known], least)
            yield pd.Series(out)

    @F.pandas_udf("boolean")
    def close(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        of = Shingles(width).of
        for left, right in trimmed(batches):
            yield pd.Series([jaccard(of(x), of(y)) >= least for x, y in zip(left, right, strict=True)], dtype=bool)

    sized, values = _for_both(pairs, prints, "size", "spread")
    left = written(sized.where(possible("a_size", "b_size", "a_spread", "b_spread")).select("a", "b"), "possible", done=[values])
    texts, values = _for_both(left, rows.select("_row", "row.text"), "text")
    return written(texts.where(close("a_text", "b_text")).select("a", "b"), "links", done=[left, values])


def near_pairs(prints: DataFrame) -> DataFrame:
    """Pairs of rows ``(a, b)`` to compare: those that the grid of :func:`fingerprint_links` joins, and rows of one fingerprint with its smallest."""
    points = written(prints.groupBy("fp").agg(F.min("_row").alias("head")), "points")
    same = prints.select("fp", F.col("_row").alias("b")).join(points.withColumnRenamed("head", "a"), "fp").select("a", "b")
    ends = fingerprint_links(points.select("fp"))
    for side in ("a", "b"):
        ends = ends.join(points.toDF(side, f"{side}_row"), side)
    both = same.unionByName(ends.select(F.least("a_row", "b_row").alias("a"), F.greatest("a_row", "b_row").alias("b")))
    return written(both.where("a <> b").distinct(), "near", done=[points])


def apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose rows the links do not join."""
    heads = components(links)
    for side in ("a", "b"):
        pairs = pairs.join(heads.toDF(side, f"{side}_head"), side, "left")
    return pairs.where("coalesce(a_head, a) <> coalesce(b_head, b)").select("a", "b")


def similar_links(prints: DataFrame, rows: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """Links ``(a, b)`` whose closure joins exactly the rows of similarity ``least`` or more, from one row of each ``key``.

    First the rows whose fingerprints meet in the grid are compared. Similar texts can lie at any distance there, so what is
    left follows by shingles: rows with one of their prefixes in common form a cell. All are compared with the smallest of their
    cell, so that a large group of near copies is joined by as many pairs as it has members. Then only rows of a cell
    that are not joined yet are compared with each other, in turns: two members of a cell, drawn by hash, with all that come after them,
    then eight times as many, and so on to the last. What a turn has joined is not compared in the next, so that a group
    in which many pairs are near, but not all, does not cost the square of its members. A pair meets in the cell of the first shingle, in the common
    order, that its rows share: where too few shingles follow it in either row, or sizes differ too much, they are not compared there.
    """
    near = near_pairs(prints)
    close = similar(near, prints, rows, least, width)
    entries = prints.select(F.col("_row").alias("r"), F.col("size").cast("int").alias("size"), F.posexplode("prefix").alias("at", "cell"))
    leaders = entries.groupBy("cell").agg(F.min(F.struct("r", "size", "at")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    leaders = written(leaders, "leaders")
    cells = written(entries.join(leaders, "cell"), "cells", done=[leaders])

    def may_be(x: str, y: str, at_x: str, at_y: str) -> Column:
        after = F.least(F.col(x) - F.col(at_x), F.col(y) - F.col(at_y))
        alike = F.least(x, y) >= F.greatest(x, y) * least - 1e-9
        return alike & (after >= (F.col(x) + F.col(y)) * (least / (1 + least)) - 1e-9)

    stars = cells.where(F.col("r") != F.col("leader.r")).where(may_be("size", "leader.size", "at", "leader.at"))
    stars = stars.select(F.col("leader.r").alias("a"), F.col("r").alias("b")).distinct()
    stars = written(apart(stars.join(near, ["a", "b"], "left_anti"), close), "stars")
    first = close.unionByName(similar(stars, prints, rows, least, width))
    heads = components(first).withColumnsRenamed({"id": "r"})
    members = written(cells.drop("leader").join(heads, "r", "left").withColumn("head", F.coalesce("component", "r")).drop("component"), "members", done=[cells])
    sized = members.join(members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cell")
    # Row numbers drawn as shares of one: times the members of a cell, about the places of its members in a common order.
    drawn = sized.withColumn("u", F.expr("shiftrightunsigned(xxhash64(r), 11) / 9007199254740992D"))
    members = written(_mixed(drawn), "mixed", done=[members])
    compared, begin, end = near.unionByName(stars), 0, TURN
    while True:
        largest, mean = members.agg(F.coalesce(F.max("n"), F.lit(-1)), F.coalesce(F.avg("n"), F.lit(0.0))).first()
        if begin > largest:
            return first
        if mean <= FEW:
            end = largest + 1
        place = F.col("u") * F.col("n")
        names = ("r", "size", "at", "head", "u")
        left = members.where((place >= begin) & (place < end)).select("cell", *names).toDF("cell", "a", "sa", "pa", "ha", "ua")
        right = members.select("cell", *names).toDF("cell", "b", "sb", "pb", "hb", "ub")
        pairs = left.join(right, "cell").where("ha <> hb and (ua < ub or ua = ub and a < b)").where(may_be("sa", "sb", "pa", "pb"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = written(pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        links = similar(pairs, prints, rows, least, width)
        compared, begin, end = compared.unionByName(pairs), end, end * 8
        if begin <= largest and not links.isEmpty():
            first, before = first.unionByName(links), members
            joined = links
            for side in ("a", "b"):
                joined = joined.join(members.select(F.col("r").alias(side), F.col("head").alias(f"h{side}")).distinct(), side)
            joined = components(joined.select(F.col("ha").alias("a"), F.col("hb").alias("b"))).withColumnsRenamed({"id": "head"})
            members = members.join(joined, "head", "left").withColumn("head", F.coalesce("component", "head")).drop("component")
            members = written(_mixed(members), "mixed", done=[before])
        else:
            first = first.unionByName(links)


def _mixed(members: DataFrame) -> DataFrame:
    """The members of cells that the links do not join whole yet."""
    mixed = members.groupBy("cell").agg(F.min("head").alias("x"), F.max("head").alias("y")).where("x < y").select("cell")
    return members.join(mixed, "cell", "left_semi")


def one_of_each(docs: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of which one stays for each group of near duplicates: the smallest doc_id, null first.

    Texts are near duplicates if the similarity (Jaccard) of their ``width``-word shingles is ``least`` or more; groups
    are closed over these links. Candidates come from the grid join of fingerprints, then from shingles: no link is lost. Rows are numbered as they are written, so that repeated rows and ids
    stay apart; all columns are kept.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = written(docs.select(F.monotonically_increasing_id().alias("_row"), own), "numbered")
    prints = written(with_prefixes(rows.select("_row", "row.text"), least, width), "prefixes")
    first = F.struct(F.col("doc_id"), F.col("_row"))
    ids = rows.select("_row", "row.doc_id").join(prints.select("_row", "key"), "_row").groupBy("key").agg(F.min(first).alias("first"), F.min("_row").alias("rep"))
    ids = written(ids, "firsts")
    # What goes is joined, not what stays: it is the smaller part, and prefixes and texts are not shuffled while it fits a broadcast.
    copies = written(prints.select("_row").join(ids.select(F.col("rep").alias("_row")), "_row", "left_anti"), "copies")
    alone = written(prints.drop("key").join(copies, "_row", "left_anti"), "different", done=[prints, copies])
    heads = components(similar_links(alone, rows, least, width)).withColumnsRenamed({"id": "rep", "component": "head"})
    kept = ids.join(heads, "rep", "left").groupBy(F.coalesce("head", "rep").alias("head")).agg(F.min("first").alias("first"))
    gone = written(rows.select("_row").join(kept.select(F.col("first._row").alias("_row")), "_row", "left_anti"), "gone", done=[alone, ids])
    return rows.join(gone, "_row", "left_anti").select("row.*")
