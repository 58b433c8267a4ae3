"""Rows drawn towards a target distribution: weights by hashed n-grams, Gumbel scores, and an exact cut by medians of medians."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ranked, table
from millrace.session import written

#: Words of UTF-8 bytes in lower case: digits, a to z, and whatever is not ASCII; and what stands between them.
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")
#: Bytes of a text that are looked at at once; no word is cut.
SLICE = 1 << 20
WEIGHTS = "n_words long, n_features long, weight long"
Key = tuple[int, int]


def feature_hashes(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """The words of a text and the crc32 of its words and pairs of neighbouring words, a slice at a time."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    at, before = 0, None
    while at < len(raw):
        gap = GAP.search(raw, at + SLICE)
        end = gap.start() if gap else len(raw)
        words = WORD.findall(raw, at, end)
        if words:
            ones = list(map(zlib.crc32, words))
            first = [zlib.crc32(b" ", h) for h in ones]
            pairs = list(map(zlib.crc32, words[1:], first))
            if before is not None:
                pairs.append(zlib.crc32(words[0], before))
            before = first[-1]
            yield len(words), np.array(ones + pairs, np.int64)
        at = end


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows by bucket: summed in each task, then by Spark; ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for _, h in feature_hashes(text):
                    total += np.bincount(h % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """What a feature of each bucket adds to a weight: its log likelihood ratio with one more of each, scaled and floored."""
    s, t, k = source.astype(float), target.astype(float), len(source)
    return np.floor(scale * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def with_weights(docs: DataFrame, target: DataFrame, buckets: int = 10_000, name: str = "weights") -> DataFrame:
    """All rows and columns and the struct ``name``: ``n_words``, ``n_features`` and ``weight`` of the whole text.

    Features are all words and pairs of neighbouring words, hashed into ``buckets``; both tables are counted in full. A
    weight is the floored mean of the gains of a row's features, 0 without any. The counts of the target are an array that
    the tasks are sent, whatever the size of either table. Null text has no words; a text may be of any length. A column
    already called ``name`` is replaced; an empty table of either kind counts as no features.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    @F.pandas_udf(WEIGHTS)
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gains = shared.value
        for texts in batches:
            out = np.zeros((len(texts), 3), np.int64)
            for row, text in zip(out, texts, strict=True):
                for n_words, h in feature_hashes(text):
                    row += (n_words, len(h), gains[h % buckets].sum())
            out[:, 2] //= np.maximum(out[:, 1], 1)
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    return docs.withColumn(name, weigh(F.col("text")))


def _beyond(key: Key, above: bool) -> Column:
    score, tie = F.col("score"), F.col("tie")
    if above:
        return (score > key[0]) | ((score == key[0]) & (tie > key[1]))
    return (score < key[0]) | ((score == key[0]) & (tie < key[1]))


def _split(rows: DataFrame, pivot: Key | None) -> dict[str, tuple[int, list[tuple[Key, int]]]]:
    """Rows above, equal to and below the pivot: how many, and the median of each task's with their number."""

    def halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(b["score"].to_numpy(), b["tie"].to_numpy()) for b in batches]
        score, tie = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
        if pivot is None:
            sides = {"below": np.ones(len(score), bool)}
        else:
            same = score == pivot[0]
            sides = {"above": (score > pivot[0]) | same & (tie > pivot[1]), "equal": same & (tie == pivot[1])}
            sides["below"] = ~(sides["above"] | sides["equal"])
        out = []
        for side, mask in sides.items():
            s, t = score[mask], tie[mask]
            if len(s):
                middle = np.lexsort((t, s))[len(s) // 2]
                out.append((side, len(s), s[middle], t[middle]))
        yield pd.DataFrame(out, columns=["side", "n", "score", "tie"])

    found: dict[str, tuple[int, list[tuple[Key, int]]]] = {side: (0, []) for side in ("above", "equal", "below")}
    for r in rows.select("score", "tie").mapInPandas(halves, "side string, n long, score long, tie long").collect():
        n, medians = found[r["side"]]
        found[r["side"]] = (n + r["n"], [*medians, ((r["score"], r["tie"]), r["n"])])
    return found


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def nth_largest(rows: DataFrame, n: int) -> Key | None:
    """The ``n``-th largest ``(score, tie)`` of a written table, exact; null for ``n`` of 0 or beyond the rows.

    In each round every task finds the median of the rows that it still holds, and the pivot is the median of these,
    weighted by how many rows each stands for. So half of the rows lie in tasks whose medians are on either side of it, and
    half of those are beyond it: a quarter of the rows goes in any round, however they are spread. One row of a task and
    side reaches the driver. What is left is written again when it is a quarter of what was.
    """
    begun = _split(rows, None)["below"]
    if not 0 < n <= begun[0]:
        return None
    held, stored, medians, bounds = rows, begun[0], begun[1], []
    while True:
        pivot = weighted_median(medians)
        sides = _split(held.where(_all(bounds)), pivot)
        above, equal = sides["above"][0], sides["equal"][0]
        if above < n <= above + equal:
            return pivot
        side = "above" if n <= above else "below"
        n -= 0 if n <= above else above + equal
        left, medians = sides[side]
        bounds.append(_beyond(pivot, side == "above"))
        if left < stored / 4:
            held = written(held.where(_all(bounds)).select("score", "tie"), "selection", done=[held] if held is not rows else [])
            stored, bounds = left, []


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def drawn(rows: DataFrame, weight: Column, eligible: Column, percent: int = 25, seed: int = 7, name: str = "draw") -> DataFrame:
    """All rows and columns and the struct ``name``: ``score``, and ``rank`` of those drawn (1 for the best, else null).

    ``score`` is the weight and a Gumbel number that ``seed`` and ``doc_id`` decide, so the highest scores are a sample
    without replacement in proportion to the exponents of the weights (by thousandths). Of the eligible rows, ``percent``
    out of a hundred, floored, are drawn: the highest scores, ties to the smaller doc_id. A null doc_id comes after
    all others and has the Gumbel number of an empty text; repeated rows tie, and as many of them are drawn as there is room for.

    Rows are written once with all columns, and those drawn are shuffled: select the columns that are needed.
    A column already called ``name`` is replaced. An empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    tie = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(-(1 << 63)))
    scored = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != name)).alias("row"), (weight.cast("long") + gumbel).alias("score"), tie.alias("tie"),
        F.coalesce(eligible, F.lit(False)).alias("eligible"),
    )
    scored = written(scored, "scores")
    many = scored.where("eligible").count() * percent // 100
    cut = nth_largest(scored.where("eligible"), many)
    chosen = F.lit(False) if cut is None else F.col("eligible") & ~_beyond(cut, False)
    best = ranked(scored.where(chosen), [], -F.col("score"), [F.desc("tie")], "place")
    rank = F.when(F.col("place") < many, F.col("place") + 1).cast("long")
    ends = best.select("row", "score", rank.alias("rank")).unionByName(scored.where(~chosen).select("row", "score", F.lit(None).cast("long").alias("rank")))
    return ends.select("row.*", F.struct("score", "rank").alias(name))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000, seed: int = 7, name: str = "draw") -> DataFrame:
    """``drawn`` by the weights of ``with_weights``, from the rows of ``min_words`` words or more; the struct has all their fields."""
    weighed = with_weights(docs, target, buckets, name)
    inner = F.col(name)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != name]
    both = weighed.select(F.struct(*columns).alias("row"), F.col("doc_id"), inner.alias("w"))
    ends = drawn(both, F.col("w.weight"), F.col("w.n_words") >= min_words, percent, seed, "d")
    return ends.select("row.*", F.struct("w.*", "d.*").alias(name))


def op13_resampling(spark, sf_dir):
    ends = resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return ends.select("doc_id", *(F.col(f"draw.{c}") for c in ("n_features", "weight", "score", "rank")))


#: The same in SQL. crc32 goes by half-bytes; the numbers are its table for them (fixed values).
SQL = r"""with texts as (
  select 'd' as side, doc_id as id, text from documents union all select 'b', row_number() over (), text from benchmark),
words as (
  select side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
runs as (
  select side, id, unnest(w) as f from words
  union all
  select side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f from words),
counted as (select side, id, f, count(*) as n from runs group by all),
raw as (select f, hex(encode(f)) as h from (select distinct f from counted)),
hashed as (
  select f, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(length(h)), lambda k:
      cast(instr('123456789ABCDEF', substr(h, cast(k + 2 - 2 * (k % 2) as integer), 1)) as bigint)),
    lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]
      [cast((xor(c, b) & 15) + 1 as integer)]))) % 10000 as bucket
  from raw),
filled as (select side, id, bucket, n from counted join hashed using (f)),
sums as (
  select bucket, coalesce(sum(n) filter (side = 'd'), 0) as s, coalesce(sum(n) filter (side = 'b'), 0) as t
  from filled group by bucket),
totals as (select cast(sum(s) as double) as bs, cast(sum(t) as double) as bt from sums),
gains as (
  select bucket, cast(floor(1000 * ln((cast(t as double) + 1) * (bs + 10000) / ((cast(s as double) + 1) * (bt + 10000)))) as bigint) as gain
  from sums, totals),
weights as (
  select id, sum(n) as n_features, floor(cast(sum(n * gain) as double) / sum(n)) as weight
  from filled join gains using (bucket) where side = 'd' group by id),
scores as (
  select w.id as doc_id, len(w.w) as n_words, cast(coalesce(n_features, 0) as bigint) as n_features,
    cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) as bigint) + cast(floor(-1000 * ln(-ln(
      (cast(cast('0x' || substr(sha256('7:' || w.id), 1, 8) as bigint) as double) + 0.5) / 4294967296))) as bigint) as score
  from words w left join weights x on w.id = x.id where w.side = 'd'),
places as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, 25 * count(*) over () // 100 as many
  from scores where n_words >= 20)
select s.doc_id, n_features, weight, score, cast(case when place <= many then place end as bigint) as rank
from scores s left join places p on s.doc_id = p.doc_id"""
