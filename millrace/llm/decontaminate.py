"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, table, trimmed
from millrace.session import written

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LETTER = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
#: Bytes of a text that are hashed at once, unless a single word is longer.
SLICE = 1 << 18
FOUND = "item_ids array<long>, similarity double"


class Hashes:
    """64-bit hashes of the words of a text, all at once: a polynomial of each word's bytes, from prefix sums.

    Words are runs of letters and digits in lower case; every byte of a character beyond ASCII counts as a letter.
    ``letter`` says of each byte whether it belongs to a word.
    """

    def __init__(self, letter: np.ndarray = LETTER) -> None:
        self.letter = letter
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        """The hashes of all words. A long text is hashed in slices that end between words, so the tables of powers stay small."""
        raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw) <= SLICE:
            return self._of(raw)
        out, at = [], 0
        while at < len(raw):
            end = at + SLICE
            while end < len(raw) and self.letter[raw[end : end + SLICE]].all():
                end += SLICE
            if end < len(raw):
                end += int(np.argmin(self.letter[raw[end : end + SLICE]]))
            out.append(self._of(raw[at:end]))
            at = end
        return np.concatenate(out)

    def _of(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        if n >= len(self.powers):
            self.powers = np.cumprod(np.full(2 * n + 1, BASE, np.uint64)) * UNBASE
            self.inverse = np.cumprod(np.full(2 * n + 1, UNBASE, np.uint64)) * BASE
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = self.letter[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h = (h ^ (h >> np.uint64(31))) * ODD[0]
        return h ^ (h >> np.uint64(30))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = sum((words[k : k + n] * ODD[k] for k in range(width)), np.zeros(n, np.uint64))
    h = (h ^ (h >> np.uint64(29))) * ODD[4]
    return h ^ (h >> np.uint64(32))


def bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def simhashes(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of ``size`` shingles."""
    sums = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum(bits(h), axis=0, out=sums[1:])
    ones = (sums[size:] - sums[:-size]) * 2 > size
    return np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)


def similarity(a: np.ndarray, b: Counter) -> float:
    """Weighted Jaccard similarity of the shingles with their counts."""
    own = Counter(a.tolist())
    both = sum(min(n, b[h]) for h, n in own.items())
    return both / max(1, len(a) + sum(b.values()) - both)


class Items:
    """Benchmark items by length in words, with a multi-index of their fingerprints.

    A fingerprint is cut into ``radius + 1`` blocks, so that any two within the radius agree on one block at least.
    """

    def __init__(self, items: list[tuple[int, str]], width: int, radius: int):
        hashes = Hashes()
        self.width, self.radius = width, radius
        self.cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.at: dict[int, list[int]] = defaultdict(list)
        self.rows: list[tuple[int, np.ndarray, Counter]] = []
        self.having: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            words = hashes.of(text)
            if len(words):
                h = shingles(words, k := min(width, len(words)))
                self.at[len(words)].append(len(self.rows))
                for x in set(h.tolist()):
                    self.having[k][x].add(len(words))
                self.rows.append((item_id, simhashes(h, len(h))[0], Counter(h.tolist())))
        self.known = {k: np.array(sorted(v), np.uint64) for k, v in self.having.items()}
        self.maybe = {}
        for k, v in self.known.items():
            self.maybe[k] = np.zeros(1 << 20, bool)
            self.maybe[k][(v & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.blocks: dict[int, list[dict[int, list[int]]]] = {}
        for size, rows in self.at.items():
            self.blocks[size] = [defaultdict(list) for _ in range(radius + 1)]
            for r in rows:
                for b, value in enumerate(self._cut(np.array([self.rows[r][1]]))):
                    self.blocks[size][b][int(value[0])].append(r)
        self.having = {k: dict(v) for k, v in self.having.items()}

    def _cut(self, fps: np.ndarray) -> list[np.ndarray]:
        return [(fps >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def found(self, words: np.ndarray, least: float) -> dict[int, float]:
        """Items whose similarity to some window of as many words is ``least`` or more, with the largest similarity.

        A text shorter than an item is one window.
        """
        out: dict[int, float] = {}
        for k, known in self.known.items():
            h = shingles(words, k)
            at = np.flatnonzero(self.maybe[k][(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
            by_size: dict[int, list[int]] = defaultdict(list)
            for p in at.tolist():
                for size in self.having[k][int(h[p])]:
                    by_size[size].append(p)
            for size, hits in by_size.items():
                self._windows(h, size, size - k + 1, np.array(hits), least, out)
        return out

    def _windows(self, h: np.ndarray, size: int, n: int, hits: np.ndarray, least: float, out: dict[int, float]) -> None:
        # A window without any shingle of an item has similarity 0, and one with too few cannot reach the bound.
        if len(h) < n:
            if len(hits) >= int(np.ceil(least * n * 0.999)):
                for r in self.at[size]:
                    if (s := similarity(h, self.rows[r][2])) >= least:
                        out[self.rows[r][0]] = max(s, out.get(self.rows[r][0], 0))
            return
        mark = np.zeros(len(h) + 1, np.int32)
        mark[hits + 1] = 1
        mark = mark.cumsum()
        full = mark[n:] - mark[:-n] >= int(np.ceil(least * n * 0.999))
        starts = np.flatnonzero(full)
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1) if len(starts) else []:
            lo, hi = run[0], run[-1] + n
            fps = simhashes(h[lo:hi], n)[run - lo]
            near: set[tuple[int, int]] = set()
            for b, values in enumerate(self._cut(fps)):
                index = self.blocks[size][b]
                for value in np.unique(values).tolist():
                    if rows := index.get(int(value)):
                        where = np.flatnonzero(values == np.uint64(value))
                        for r in rows:
                            close = where[np.bitwise_count(fps[where] ^ self.rows[r][1]) <= self.radius]
                            near.update((r, w) for w in close.tolist())
            for r, w in near:
                item, s = self.rows[r][0], similarity(h[run[w] : run[w] + n], self.rows[r][2])
                if s >= least:
                    out[item] = max(s, out.get(item, 0))


def _finder(shared, least: float):
    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        give_back()
        hashes, items = Hashes(), shared.value
        for texts in trimmed(batches):
            got = [items.found(hashes.of(t), least) for t in texts]
            yield pd.DataFrame({"item_ids": [sorted(g) for g in got], "similarity": [max(g.values(), default=0.0) for g in got]})

    return find


def with_passages(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5, radius: int = 20, block: int = 20_000, name: str = "found") -> DataFrame:
    """All rows and columns and ``name``: the items that a window of the text repeats, and the largest similarity.

    Words are runs of letters and digits in lower case. Items of fewer than ``width`` words count as one shingle;
    items without words match nothing. The benchmark is a stated query set: it is sent to the tasks ``block`` items
    at a time, each block matched against all rows, and the answers are joined in the row. Null text is empty.
    """
    spark = docs.sparkSession
    queries = benchmark.where("text is not null and item_id is not null").select("item_id", "text").distinct()
    parts = max(1, -(-queries.count() // block))
    queries = queries.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    queries = written(queries, "benchmark") if parts > 1 else queries
    columns = []
    for part in range(parts):
        items = Items([(r["item_id"], r["text"]) for r in queries.where(F.col("_part") == part).collect()], width, radius)
        columns.append(_finder(spark.sparkContext.broadcast(items), least)(F.col("text")))
    if parts == 1:
        return docs.withColumn(name, columns[0])
    whole = docs.withColumn(name, F.array(*columns))
    ids = F.array_sort(F.flatten(F.col(name)["item_ids"]))
    return whole.withColumn(name, F.struct(ids.alias("item_ids"), F.array_max(F.col(name)["similarity"]).alias("similarity")))


def op5_decontamination(spark, sf_dir):
    """One row per document: the benchmark items it repeats."""
    found = with_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("found.item_ids") > 0).alias("contaminated"), F.size("found.item_ids").cast("long").alias("n_items"), "found.item_ids", "found.similarity")
