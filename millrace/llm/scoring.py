"""Language-model scores: causal self-attention over subword ids, trained by numpy on all rows in Spark.

The attention layer predicts the class of the next id: it starts from the counts of classes after the id before and learns what the
ids further back add. Counts of id pairs give the id within its class. So every place has one distribution over all ids, and
``score`` is the sum of its logarithms.
"""

from __future__ import annotations

import copy
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, table, trimmed
from millrace.llm.packing import tokenizer_path, word_ids
from millrace.session import written

VOCABULARY = 49_408
CONTEXT, STEP = 32, 24
CLASSES, WIDTH = 64, 8
#: Ids with a vector of their own; the less frequent ones share them by remainder.
OWN = 4_096
#: Words counted most often are scored in the map, at most so many; the others are joined. Likewise pairs of ids.
FREQUENT, PAIRS = 50_000, 400_000
#: How many places the counts of single ids weigh among those of pairs.
PRIOR = 20.0
#: Sixteenths of the rows that a round of training ends before, and its rate: partitions meet early and learn most from the mean.
ROUNDS = ((0, 2, 0.04), (2, 6, 0.03), (6, 16, 0.02))
#: Rows whose texts, windows, words and pairs a task holds at a time, and distinct words that it counts before it hands them on.
BATCH, ROWS, WORDS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000, 100_000
#: Rows that are scored at a time: the words and pairs that are not looked up take much more room than the texts.
SCORED = 200
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def windows(n: int) -> list[tuple[int, int]]:
    """``(begin, first scored)`` of windows of ``CONTEXT`` places; every place is scored once, all but the first with context."""
    return [(0, 0), *((s - CONTEXT + STEP, s) for s in range(CONTEXT, n, STEP))]


def class_of_ids(counts: np.ndarray, pairs: tuple[np.ndarray, ...], classes: int = CLASSES, dims: int = 12, seed: int = 3) -> np.ndarray:
    """Ids with like neighbours on both sides share a class: leading singular vectors of the scaled pair counts, then k-means on the sphere."""
    before, after, n = pairs
    of, seen = np.zeros(len(counts), np.int64), np.flatnonzero(counts)
    if len(seen) < 2:
        return of
    scaled = n / np.sqrt((counts[before] + 1) * (counts[after] + 1))
    sides = [np.random.default_rng(seed).normal(size=(len(counts), dims))] * 2
    for _ in range(12):
        for side, mine, other in ((0, before, after), (1, after, before)):
            sides[side] = np.linalg.qr(np.stack([np.bincount(mine, scaled * x[other], len(counts)) for x in sides[1 - side].T], axis=1))[0]
    y, weight = np.hstack([x[seen] / (np.linalg.norm(x[seen], axis=1, keepdims=True) + 1e-30) for x in sides]), np.sqrt(counts[seen])
    centres = y[np.argsort(-weight, kind="stable")[:classes]].copy()
    for _ in range(15):
        nearest = np.argmax(y @ centres.T, axis=1)
        sums = np.stack([np.bincount(nearest, weight * x, len(centres)) for x in y.T], axis=1)
        norms = np.linalg.norm(sums, axis=1)
        centres[norms > 0] = sums[norms > 0] / norms[norms > 0, None] * math.sqrt(2)
    of[seen] = nearest
    return np.unique(of, return_inverse=True)[1]


class Model:
    """One causal attention layer over the counts ``(before, class, n)`` of classes after an id; all tables are bounded by the vocabulary."""

    def __init__(self, counts: np.ndarray, of: np.ndarray, pairs: tuple[np.ndarray, ...], seed: int = 3):
        draw, self.of = np.random.default_rng(seed), of
        of_class = np.bincount(of, counts + 0.5)
        self.within = PRIOR * (counts + 0.5) / of_class[of]
        after = np.zeros((len(counts), len(of_class)))
        np.add.at(after, pairs[:2], pairs[2])
        self.after = after.astype(np.float32)
        self.prior = np.log((after + PRIOR * of_class / of_class.sum()) / (after.sum(axis=1, keepdims=True) + PRIOR)).astype(np.float32)
        self.own = np.arange(len(counts)) % OWN
        self.own[np.argsort(-counts, kind="stable")[:OWN]] = np.arange(min(OWN, len(counts)))
        self.p = {"ids": draw.normal(0, 0.3, (OWN, WIDTH)), "places": draw.normal(0, 0.1, (CONTEXT, WIDTH))}
        self.p |= {k: draw.normal(0, 0.4, (WIDTH, WIDTH)) for k in ("q", "k", "v", "x", "o")}
        self.p |= {"c": np.zeros((WIDTH, len(of_class)))}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.cause = np.triu(np.full((CONTEXT, CONTEXT), -1e9, np.float32), 1)
        self.scale = np.float32(1 / math.sqrt(WIDTH))

    def forward(self, ids: np.ndarray) -> tuple:
        """Unscaled probabilities of the classes, a row for each place of each window, from the ids before it. A padded place follows all real ones.

        Entries of ``c`` are kept within 5, so that these lie between e**-70 and e**40 and need no shift.
        """
        p, (rows, n) = self.p, ids.shape
        x = (p["ids"][self.own[ids]] + p["places"][:n]).reshape(-1, WIDTH)
        q, k, v = ((x @ p[name]).reshape(rows, n, WIDTH) for name in "qkv")
        a = (q * self.scale) @ k.transpose(0, 2, 1)
        if a.size and not -60 < a.min() <= a.max() < 60:
            a += self.cause[:n, :n]
            a -= a.max(axis=2, keepdims=True)
        else:  # exponentials of all and their sums fit as they are
            a += self.cause[:n, :n]
        np.exp(a, out=a)
        a /= np.einsum("rij->ri", a)[:, :, None]
        s = (a @ v).reshape(-1, WIDTH)
        h = np.tanh(x @ p["x"] + s @ p["o"])
        out = h @ p["c"]
        out += self.prior[ids.ravel()]
        np.exp(out, out=out)
        return x, q, k, v, a, s, h, out

    def train_on(self, batches: Iterable[list[np.ndarray]], rate: float, batch: int = 128, seed: int = 4) -> int:
        """Adam over windows side by side that hold every place of all texts once; how many windows there were."""
        m, w = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        draw, seen, step = np.random.default_rng(seed), 0, 0
        for texts in batches:
            flat, of, begin, length = spans_of(texts, [[(s, s) for s in range(0, len(t), CONTEXT)] for t in texts])[:4]
            seen += len(begin)
            order = draw.permutation(len(begin))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                step += 1
                for name, grad in self.gradients(*inputs(flat, of[some], begin[some], length[some])).items():
                    m[name] += 0.1 * (grad - m[name])
                    w[name] += 0.01 * (grad * grad - w[name])
                    self.p[name] -= np.float32(rate / (1 - 0.9**step)) * m[name] / (np.sqrt(w[name] * np.float32(1 / (1 - 0.99**step))) + np.float32(1e-8))
                np.clip(self.p["c"], -5, 5, out=self.p["c"])
        return seen

    def gradients(self, ids: np.ndarray, nxt: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over real places."""
        p, g, shape = self.p, {}, (*ids.shape, WIDTH)
        x, q, k, v, a, s, h, d = self.forward(ids)
        d *= (mask.ravel() / (mask.sum() * (d @ np.ones(d.shape[1], d.dtype))))[:, None]
        d[np.arange(nxt.size), self.of[nxt].ravel()] -= mask.ravel() / mask.sum()
        g["c"] = h.T @ d
        dz = (d @ p["c"].T) * (1 - h * h)
        g["x"], g["o"] = x.T @ dz, s.T @ dz
        ds, dx = (dz @ p["o"].T).reshape(shape), dz @ p["x"].T
        da, dv = ds @ v.transpose(0, 2, 1), a.transpose(0, 2, 1) @ ds
        da -= np.einsum("rij,rij->ri", da, a)[:, :, None]
        da *= a
        da *= self.scale
        for name, y in (("q", da @ k), ("k", da.transpose(0, 2, 1) @ q), ("v", dv)):
            y = y.reshape(-1, WIDTH)
            g[name] = x.T @ y
            dx += y @ p[name].T
        g["places"] = np.zeros_like(p["places"])
        g["places"][: ids.shape[1]] = dx.reshape(shape).sum(axis=0)
        rows = self.own[ids].ravel()
        g["ids"] = np.stack([np.bincount(rows, column, len(p["ids"])) for column in dx.T], axis=1).astype(np.float32)
        return g

    def scores(self, texts: list[np.ndarray], batch: int = 128) -> np.ndarray:
        """log10 of the probability of each text's classes, by overlapping windows; each place counts once."""
        total = np.zeros(len(texts))
        flat, of, begin, length, first, text = spans_of(texts, [windows(len(t)) if len(t) else [] for t in texts])
        order = np.argsort(length, kind="stable")
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            ids, nxt, mask = inputs(flat, of[some], begin[some], length[some])
            out = self.forward(ids)[-1]
            hit = out[np.arange(nxt.size), self.of[nxt].ravel()] / (out @ np.ones(out.shape[1], out.dtype))
            got = np.log10(hit).reshape(nxt.shape)
            fresh = mask * (np.arange(ids.shape[1]) >= first[some][:, None])
            total += np.bincount(text[some], (got * fresh).sum(axis=1, dtype=np.float64), len(texts))
        return total


def spans_of(texts: list[np.ndarray], spans: list[list[tuple[int, int]]]) -> tuple[np.ndarray, ...]:
    """All texts end to end, and for each window: its text's start there, begin, length, first place that counts, and text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), [len(s) for s in spans])
    begin, first = np.array([b for s in spans for b in s], np.int64).reshape(-1, 2).T
    return flat, starts[text], begin, np.minimum(CONTEXT, sizes[text] - begin), first - begin, text


def inputs(flat: np.ndarray, of: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id before each place (0 at the start of a text), the id at it, and which places are real."""
    place = np.arange(length.max())
    at = (of + begin)[:, None] + np.minimum(place, length[:, None] - 1)
    ids = flat[np.maximum(at - 1, 0)]
    ids[begin == 0, 0] = 0
    return ids, flat[at], (place < length[:, None]).astype(np.float32)


def trained_on_all(model: Model, training: DataFrame) -> None:
    """Rounds of training that cover every row once: partitions fit at the same time, and Spark sums parameters by windows."""
    names = list(model.p)
    for begin, end, rate in ROUNDS:
        shared = training.sparkSession.sparkContext.broadcast(model)

        def fit(batches: Iterator[pd.DataFrame], shared=shared, rate=rate) -> Iterator[pd.DataFrame]:
            give_back()
            own = copy.copy(shared.value)
            own.p = {k: x.copy() for k, x in own.p.items()}
            parts = (b["ids"].iloc[at : at + ROWS] for b in trimmed(batches) for at in range(0, len(b), ROWS))
            seen = own.train_on(([ids_of(x) for x in part] for part in parts), rate)
            if seen:
                values = np.concatenate([own.p[k].ravel() for k in names]).astype(np.float64)
                yield pd.DataFrame({"k": np.arange(len(values), dtype=np.int32), "value": values * seen, "seen": seen})

        part = training.where(F.pmod(F.xxhash64("_row"), F.lit(16)).between(begin, end - 1)).select("ids")
        sums = part.mapInPandas(fit, "k int, value double, seen long").groupBy("k").agg((F.sum("value") / F.sum("seen")).alias("value"))
        got = sums.toPandas().sort_values("k")["value"].to_numpy()
        shared.unpersist()
        if len(got):
            ends = np.cumsum([model.p[k].size for k in names])[:-1]
            model.p = {k: v.reshape(model.p[k].shape).astype(np.float32) for k, v in zip(names, np.split(got, ends), strict=True)}


def ids_of(held: bytes) -> np.ndarray:
    """Ids as they are written, two bytes each: ``VOCABULARY`` is below 65,536, and no task reads them one by one."""
    return np.frombuffer(held, "<u2").astype(np.int64)


def pair_codes(ids: np.ndarray) -> np.ndarray:
    """Each id after the one before it, 0 at the start, as one number."""
    ids = np.asarray(ids, np.int64)
    return np.concatenate([[0], ids[:-1]])[: len(ids)] * VOCABULARY + ids


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Rows with the largest ``n``, at most ``most`` of them: the bound is counted by steps of an eighth of a power of two."""
    step = F.floor(F.log2("n") * 8)
    left, least = most, None
    for r in counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("step")).collect():
        if r["rows"] > left:
            break
        left, least = left - r["rows"], r["step"]
    return counted.where("false" if least is None else step >= least)


def scored(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Scores of all whole texts; rows with crc32(doc_id) mod 5 = 1 are held out of everything that is learned.

    Counts of words, of subword ids and of pairs of ids cover all training rows, and the attention layer is fitted to every
    place of all of them. ``score`` is the log10 probability of a text's ids: at each place that of the id's class, from the attention layer,
    times that of the id among its class after the id before it, from the pair counts. The most frequent pairs are looked up in
    the map, all others joined. ``attention_gain`` is what the layer adds over the class counts alone (part of ``score``).
    ``base_score`` sums smoothed word frequencies, looked up or joined likewise. Null and empty texts have the end as their only token.
    Rows are numbered as they are written, so repeated rows stay apart and columns of any name do no harm; a null doc_id is not held
    out. Long texts are read whole, window by window. Without training rows all counts are 0; an empty table gives an empty one.
    """
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    if spark.conf.get(BATCH) == "10000":  # as Spark has it by default
        spark.conf.set(BATCH, ROWS)

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = word_ids(path)
        for texts in trimmed(batches):
            yield pd.Series([np.frombuffer(b + b"\0\0\0\0", "<u4").astype("<u2").tobytes() for b in table.of(texts.tolist())])

    held = F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5 = 1, false)")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text", held.alias("held_out"), encode(F.col("text")).alias("ids"))
    rows = written(rows, "encoded")
    training = rows.where("not held_out")

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        total: Counter = Counter()
        for batch in trimmed(batches):
            for text in batch["text"]:
                total.update(words_of(text))
                if len(total) > WORDS:
                    yield pd.DataFrame({"word": pd.Series(list(total.keys()), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})
                    total = Counter()
        yield pd.DataFrame({"word": pd.Series(list(total.keys()), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    counts = training.select("text").mapInPandas(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts, "word_counts")
    words, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = training.count()
    n, v = words + ends, kinds + (ends > 0)
    known = {bytes(r["word"]): math.log10(r["n"] + 0.5) for r in most_frequent(counts, FREQUENT).collect()}
    rest = math.log10(n + 0.5 * (v + 1))

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        for ids in (b["ids"].iloc[at : at + ROWS] for b in trimmed(batches) for at in range(0, len(b), ROWS)):
            codes, n = np.unique(np.concatenate([pair_codes(ids_of(x)) for x in ids]), return_counts=True)
            yield pd.DataFrame({"pair": codes, "n": n})

    pairs = written(training.select("ids").mapInPandas(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    id_counts = np.zeros(VOCABULARY)
    for r in pairs.groupBy(F.expr(f"pair % {VOCABULARY}").alias("id")).agg(F.sum("n").alias("n")).collect():
        id_counts[r["id"]] = r["n"]
    often = most_frequent(pairs, PAIRS).toPandas().sort_values("pair")
    often_codes, often_counts = often["pair"].to_numpy(np.int64), often["n"].to_numpy(np.float64)
    # Pairs beyond the most frequent ones count in the classes of the ids that they end with: a row for each id and class.
    by_class = class_of_ids(id_counts, (often_codes // VOCABULARY, often_codes % VOCABULARY, often_counts))
    of_id = spark.createDataFrame([(k, c) for k, c in enumerate(by_class.tolist())], "id int, class int")
    after = pairs.select(F.expr(f"pair div {VOCABULARY}").cast("int").alias("before"), F.expr(f"pair % {VOCABULARY}").cast("int").alias("id"), "n")
    after = after.join(F.broadcast(of_id), "id").groupBy("before", "class").agg(F.sum("n").alias("n")).toPandas()
    model = Model(id_counts, by_class, (after["before"].to_numpy(np.int64), after["class"].to_numpy(np.int64), after["n"].to_numpy(np.float64)))
    trained_on_all(model, training)
    shared = spark.sparkContext.broadcast((model, known, often_codes, often_counts))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, known, often_codes, often_counts = shared.value
        give_back()
        for batch in (b.iloc[at : at + SCORED] for b in trimmed(batches) for at in range(0, len(b), SCORED)):
            out, texts = [], [ids_of(x) for x in batch["ids"]]
            for row, doc_id, text, held_out, ids in zip(batch["_row"], batch["doc_id"], batch["text"], batch["held_out"], texts, strict=True):
                codes, times = np.unique(pair_codes(ids), return_counts=True)
                before, after = np.divmod(codes, VOCABULARY)
                at = np.minimum(np.searchsorted(often_codes, codes), max(len(often_codes) - 1, 0))
                hit = often_codes[at] == codes if len(often_codes) else np.zeros(len(codes), bool)
                of, prior = model.of[after], model.within[after]
                paired = (times[hit] * np.log10(often_counts[at[hit]] + prior[hit])).sum() - (times * np.log10(model.after[before, of] + PRIOR)).sum()
                counted = (times * model.prior[before, of]).sum() / math.log(10)
                found = Counter(words_of(text))
                logs = [known.get(w) for w in found]
                seldom = [w for w, x in zip(found, logs, strict=True) if x is None]
                seldom_times = [found[w] for w in seldom]
                have = found.total() - sum(seldom_times) + (ends > 0)
                total = math.log10(ends + 0.5) + sum(k * x for k, x in zip(found.values(), logs, strict=True) if x is not None)
                ends_too = found.total() + 1
                rare = (seldom, seldom_times, codes[~hit], times[~hit])
                out.append((row, None if pd.isna(doc_id) else int(doc_id), held_out, ends_too, have, total, paired, counted, *rare))
            names = ["_row", "doc_id", "held_out", "n_tokens", "have", "total", "paired", "counted", "words", "word_times", "pairs", "pair_times"]
            frame = pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
            frame["attended"] = model.scores(texts)
            yield frame

    shape = (
        "_row long, doc_id long, held_out boolean, n_tokens long, have long, total double, paired double, counted double, "
        "words array<binary>, word_times array<long>, pairs array<long>, pair_times array<long>, attended double"
    )
    part = written(rows.select("_row", "doc_id", "text", "held_out", "ids").mapInPandas(score, shape), "scored")
    rare = part.select("_row", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("word_times").alias("k"))).alias("r"))
    rare = rare.select("_row", "r.*").toDF("_row", "word", "k").join(counts, "word", "left")
    rare = rare.groupBy("_row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("also"),
    )
    priors = spark.createDataFrame([(k, float(x)) for k, x in enumerate(model.within.tolist())], "id long, prior double")
    seldom = part.select("_row", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("pair_times").alias("k"))).alias("p"))
    seldom = seldom.select("_row", "p.*").toDF("_row", "pair", "k").join(pairs, "pair", "left")
    seldom = seldom.withColumn("id", F.col("pair") % VOCABULARY).join(F.broadcast(priors), "id")
    seldom = seldom.groupBy("_row").agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.col("prior"))).alias("joined"))
    done = part.drop("words", "word_times", "pairs", "pair_times").join(rare, "_row", "left").join(seldom, "_row", "left")
    return done.select(
        "doc_id", "held_out", "n_tokens", (F.col("have") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("total") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * rest).alias("base_score"),
        (F.col("attended") + F.col("paired") + F.coalesce("joined", F.lit(0.0))).alias("score"),
        (F.col("attended") - F.col("counted")).alias("attention_gain"),
    )


def op2_scoring(spark, sf_dir):
    return scored(table(spark, sf_dir, "documents"))
