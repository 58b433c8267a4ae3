"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import kept, table, trimmed

WORD = re.compile(r"[^\W_]+")
WINDOW, STEP = 32, 24
GRAMS = 4096
#: Of a document with label 0, the windows of each epoch; of one with label 1, from the second epoch on.
CLEAN, TOXIC = 3, 2
#: Longer runs of letters are words in pieces of this length, the next beginning ``LAP`` characters before the last ends.
PIECE, LAP = 40, 10
#: A worker keeps the inputs of some so many words and scores so many windows at a time: it shares its executor's memory with others.
KEPT, WINDOWS = 50_000, 512
#: Words of texts that are held until their windows are scored.
HELD = 50_000


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over ``n`` words; every word lies in one at least."""
    if n <= WINDOW:
        return [(0, n)]
    starts = list(range(0, n - WINDOW, STEP)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def words_of(text: str | None) -> list[str]:
    words = WORD.findall((text or "").lower())
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[s : s + PIECE] for w in words for s in range(0, max(1, len(w) - LAP), PIECE - LAP)]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of three neighbouring bytes of ``<word>``, for all words in a row, and where each word's codes begin."""
    raw = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    codes = (b[:-2] * 961 + b[1:-1] * 31 + b[2:] + (b[:-2] * b[2:]) * 7) % GRAMS
    ends = np.cumsum([len(x) for x in raw])
    starts = ends - [len(x) for x in raw]
    inside = np.ones(len(codes), bool)
    inside[np.concatenate([ends[:-1] - 2, ends[:-1] - 1])] = False
    return codes[inside], starts - 2 * np.arange(len(words))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Net:
    """Word vector plus mean of its character vectors, a gated unit each way, attention pooling, one logit."""

    def __init__(self, vocabulary: dict[str, int], width: int = 12, hidden: int = 8, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.vocabulary, self.hidden = vocabulary, hidden
        self.p = {"words": np.zeros((len(vocabulary) + 1, width)), "grams": draw.normal(0, 0.1, (GRAMS, width))}
        for way in "fb":
            self.p[f"W{way}"] = draw.normal(0, 0.3, (width, 3 * hidden))
            self.p[f"U{way}"] = draw.normal(0, 0.3, (hidden, 3 * hidden))
            self.p[f"c{way}"] = np.zeros(3 * hidden)
        self.p |= {"v": draw.normal(0, 0.3, 2 * hidden), "w": draw.normal(0, 0.3, 2 * hidden), "b": np.zeros(1)}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.p.items()}
        self.steps, self.calibration = 0, np.array([1.0, 0.0, 0.0])

    def vectors(self, words: list[str]) -> np.ndarray:
        codes, starts = grams_of(words)
        sums = np.add.reduceat(self.p["grams"][codes], starts, axis=0)
        counts = np.diff(np.append(starts, len(codes)))[:, None]
        return self.p["words"][[self.vocabulary.get(w, 0) for w in words]] + sums / counts

    def unit(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``x`` holds the projected inputs by step."""
        n, H, U = x.shape[1], self.hidden, self.p[f"U{way}"]
        h, out = np.zeros((n, H), np.float32), np.empty((*x.shape[:2], H), np.float32)
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            u = h @ U
            zr = sigmoid(x[t, :, : 2 * H] + u[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            c = np.tanh(x[t, :, 2 * H :] + r * u[:, 2 * H :])
            if keep is not None:
                keep.append((t, h, z, r, c, u[:, 2 * H :]))
            h = (c + z * (h - c)) * mask[t][:, None]
            out[t] = h
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.where(mask > 0, states @ self.p["v"], -30)
        a = np.exp(a - a.max(axis=0)) * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        return a, np.einsum("tn,tnh->nh", a, states)

    def logits(self, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self.unit(xf, mask, "f"), self.unit(xb, mask, "b")], axis=2)
        return self.pooled(states, mask)[1] @ self.p["w"] + self.p["b"][0]

    def learn(self, ids: np.ndarray, places: np.ndarray, grams: np.ndarray, counts: np.ndarray, mask: np.ndarray, y: np.ndarray, rate: float) -> None:
        """One Adam step. ids: words by step; places: the real ones in a row; grams, counts: all their character codes, and how many each has."""
        p, H, g = self.p, self.hidden, {}
        x = p["words"][ids]
        means = np.add.reduceat(p["grams"][grams], np.cumsum(counts) - counts, axis=0) / counts[:, None]
        x.reshape(-1, x.shape[2])[places] += means.astype(np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.unit(x @ p[f"W{k}"] + p[f"c{k}"], mask, k, kept[k]) for k in "fb"], axis=2)
        a, c = self.pooled(states, mask)
        d = ((sigmoid(c @ p["w"] + p["b"][0]) - y) / len(y)).astype(np.float32)
        g["w"], g["b"] = c.T @ d, np.array([d.sum()])
        dc = d[:, None] * p["w"]
        along = np.einsum("nh,tnh->tn", dc, states)
        da = a * (along - (a * along).sum(axis=0))
        g["v"] = np.einsum("tn,tnh->h", da, states)
        ds = a[:, :, None] * dc + da[:, :, None] * p["v"]
        dx = np.zeros_like(x)
        for k, part in (("f", ds[:, :, :H]), ("b", ds[:, :, H:])):
            dh, dU = np.zeros((len(y), H), np.float32), np.zeros_like(p[f"U{k}"])
            dall = np.zeros((*x.shape[:2], 3 * H), np.float32)
            for t, h, z, r, cand, uc in reversed(kept[k]):
                dh = (dh + part[t]) * mask[t][:, None]
                dn = dh * (1 - z) * (1 - cand**2)
                dz, dr = dh * (h - cand) * z * (1 - z), dn * uc * r * (1 - r)
                dall[t] = np.concatenate([dz, dr, dn], axis=1)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                dU += h.T @ du
                dh = dh * z + du @ p[f"U{k}"].T
            g[f"U{k}"], g[f"c{k}"] = dU, dall.sum(axis=(0, 1))
            g[f"W{k}"] = np.einsum("tnd,tnh->dh", x, dall)
            dx += dall @ p[f"W{k}"].T
        g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(g["words"], ids, dx)
        np.add.at(g["grams"], grams, np.repeat(dx.reshape(-1, dx.shape[2])[places] / counts[:, None].astype(np.float32), counts, axis=0))
        self.steps += 1
        for k, grad in g.items():
            m, v = self.moments[k]
            grad = grad + 1e-5 * p[k]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p[k] -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)).astype(np.float32)


class Scorer:
    """Scores texts with a trained net; inputs of words are projected once and kept."""

    def __init__(self, net: Net, most: int = 200_000, batch: int = 2048):
        self.net, self.most, self.batch = net, most, batch
        self._begin()

    def _begin(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, 6 * self.net.hidden), np.float32)
        self.used = 1

    def _learn(self, words: list[str]) -> None:
        p = self.net.p
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            x = self.net.vectors(some)
            if self.used + len(some) > len(self.table):
                larger = np.zeros((max(self.used + len(some), min(2 * len(self.table), self.most)), self.table.shape[1]), np.float32)
                larger[: self.used] = self.table[: self.used]
                self.table = larger
            self.table[self.used : self.used + len(some)] = np.concatenate([x @ p["Wf"] + p["cf"], x @ p["Wb"] + p["cb"]], axis=1)
            self.rows.update(zip(some, range(self.used, self.used + len(some)), strict=True))
            self.used += len(some)

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text, given as words, the logits of all its windows."""
        spans = [(k, s, e) for k, words in enumerate(texts) for s, e in windows(len(words))]
        new = {w for words in texts for w in words if w not in self.rows}
        if self.used > 1 and self.used + len(new) > self.most:
            self._begin()
            new = {w for words in texts for w in words}
        self._learn(list(new))
        rows = [np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)) for words in texts]
        flat, ends = np.zeros(len(spans)), np.zeros(len(texts) + 1, np.int64)
        H3 = 3 * self.net.hidden
        order = sorted(range(len(spans)), key=lambda k: spans[k][2] - spans[k][1])
        for at in range(0, len(order), self.batch):
            part = order[at : at + self.batch]
            steps = max(1, spans[part[-1]][2] - spans[part[-1]][1])
            ids, mask = np.zeros((steps, len(part)), np.int64), np.zeros((steps, len(part)), np.float32)
            for col, k in enumerate(part):
                text, s, e = spans[k]
                ids[: e - s, col], mask[: e - s, col] = rows[text][s:e], 1
            x = self.table[ids]
            flat[part] = self.net.logits(x[:, :, :H3], x[:, :, H3:], mask)
        for k, _, _ in spans:
            ends[k + 1] += 1
        ends = ends.cumsum()
        return [flat[ends[k] : ends[k + 1]] for k in range(len(texts))]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The calibrated largest logit; windows are scored some thousand words at a time, so memory is bounded."""
        best, pending, held = np.zeros((len(texts), 2)), [], 0
        for k, text in enumerate(texts):
            words = words_of(text)
            # A very long text goes in pieces that overlap as windows do.
            for s in range(0, max(1, len(words) - WINDOW + STEP), STEP * 2048):
                pending.append((k, words[s : s + STEP * 2047 + WINDOW]))
                held += len(pending[-1][1])
                if held > HELD:
                    self._merge(best, pending)
                    pending, held = [], 0
        self._merge(best, pending)
        a = self.net.calibration
        return sigmoid(a[0] * best[:, 0] + a[1] * np.log(np.maximum(best[:, 1], 1)) + a[2])

    def _merge(self, best: np.ndarray, pending: list[tuple[int, list[str]]]) -> None:
        for (k, _), got in zip(pending, self.window_logits([w for _, w in pending]), strict=True):
            best[k, 0] = max(best[k, 0], got.max()) if best[k, 1] else got.max()
            best[k, 1] += len(got)


def train(texts: list[str], labels: list[int], negatives_per_positive: float = 1.0, epochs: int = 10, seed: int = 5) -> Net:
    """A net for documents of which a label 1 says that some window is toxic.

    A fifth of the rows is set aside to calibrate scores, with negatives weighted to their share. All windows of the
    others are scored in each epoch from the second on, and those that the net finds most toxic are learned from: the
    two highest of a toxic document, the three highest of a clean one (in the first epoch, three of either at random).
    Without both labels the net scores all rows alike.
    """
    draw = np.random.default_rng(seed)
    words, y = [words_of(t) for t in texts], np.array(labels, np.float32)
    aside = np.arange(len(words)) % 5 == 4
    df = Counter(w for k, ws in enumerate(words) if not aside[k] for w in set(ws))
    net = Net({w: i + 1 for i, w in enumerate(sorted(w for w, n in df.items() if n >= 3))}, seed=seed)
    if len(set(labels)) < 2 or len(set(y[~aside])) < 2:
        rate = min(max(float(y.mean()) if len(y) else 0.0, 0.01), 0.99)
        net.calibration = np.array([0.0, 0.0, np.log(rate / (1 - rate))])
        return net
    grams: dict[str, list[int]] = {}

    def inputs(chosen: list[tuple[int, int, int]]):
        n = len(chosen)
        ids, mask = np.zeros((WINDOW, n), np.int64), np.zeros((WINDOW, n), np.float32)
        places, codes, counts = [], [], []
        for col, (k, s, e) in enumerate(chosen):
            for t, w in enumerate(words[k][s:e]):
                if w not in grams:
                    grams[w] = grams_of([w])[0].tolist()
                ids[t, col], mask[t, col] = net.vocabulary.get(w, 0), 1
                places.append(t * n + col)
                codes += grams[w]
                counts.append(len(grams[w]))
        ids[draw.random(ids.shape) < 0.1] = 0
        return ids, np.array(places), np.array(codes), np.array(counts), mask, y[[k for k, _, _ in chosen]]

    mine = [k for k in range(len(words)) if not aside[k] and words[k]]
    for epoch in range(epochs):
        chosen = []
        if epoch:
            for k, got in zip(mine, Scorer(net).window_logits([words[k] for k in mine]), strict=True):
                spans = windows(len(words[k]))
                chosen += [(k, *spans[q]) for q in np.argsort(-got)[: TOXIC if y[k] else CLEAN]]
        else:
            for k in mine:
                spans = windows(len(words[k]))
                chosen += [(k, *spans[q]) for q in draw.permutation(len(spans))[:CLEAN]]
        for part in np.array_split(draw.permutation(len(chosen)), max(1, len(chosen) // 96)):
            net.learn(*inputs([chosen[q] for q in part]), rate=0.01 if epoch < epochs - 3 else 0.003)
    held = [k for k in range(len(words)) if aside[k]]
    if len({y[k] for k in held}) < 2:
        held = list(range(len(words)))
    got = Scorer(net).window_logits([words[k] for k in held])
    X = np.array([[x.max(), np.log(len(x)), 1] for x in got])
    t, a = y[held], np.array([1.0, 0.0, 0.0])
    weight = np.where(t > 0, 1.0, negatives_per_positive)
    for _ in range(30):
        q = sigmoid(X @ a)
        hessian = (X * (weight * q * (1 - q))[:, None]).T @ X + np.diag([0.02, 0.3, 0.02])
        step = np.linalg.solve(hessian, X.T @ (weight * (t - q)) - np.array([0.02, 0.3, 0.02]) * (a - [1, 0, 0]))
        a += np.clip(step, -2, 2)
    net.calibration = a
    return net


def chosen_ids(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id`` and ``toxic`` of at most ``most`` labelled rows of each label, those of the smallest hashes.

    Only ids and labels are read. Labels below a bound of the hash are looked up among the documents, and the bound is
    raised until there are enough or no more: a few times ``most`` rows reach the driver, however large the tables.
    """
    spark, found = docs.sparkSession, []
    h = F.xxhash64(F.lit(3), "doc_id")
    here = docs.where("text is not null and crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").select("doc_id")
    for label in (0, 1):
        known = labels.where(F.col("toxic") == label).select("doc_id", "toxic", h.alias("h"))
        many, share = known.count(), 0.0
        while share < 1:
            share = min(1.0, max(2 * share, 4 * most / max(1, many)))
            low = known if share == 1 else known.where(F.col("h") < int(-(2**63) + share * 2**64))
            rows = here.join(low, "doc_id").groupBy("doc_id", "h").agg(F.max("toxic").alias("toxic")).orderBy("h", "doc_id").limit(most).collect()
            if len(rows) == most:
                break
        found += [(r["doc_id"], r["toxic"]) for r in rows]
    return spark.createDataFrame(found, "doc_id long, toxic int")


def learned(docs: DataFrame, labels: DataFrame, most: int = 900) -> Net:
    """A net from at most ``most`` labelled rows of each label, by order of a hash, none with crc32(doc_id) mod 3 = 1.

    A document that both labels are given for is toxic. Ids are chosen first; only the texts of those are read out, of an
    id that several rows have the smallest.
    """
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    ids = F.broadcast(chosen_ids(docs, known, most))
    texts = docs.where("text is not null").select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = texts.select("text", "toxic", F.xxhash64(F.lit(3), "doc_id").alias("h")).collect()
    chosen = [sorted((r for r in rows if r["toxic"] == label), key=lambda r: (r["h"], r["text"])) for label in (0, 1)]
    found = [r for pair in zip(*(c + [None] * (most - len(c)) for c in chosen), strict=True) for r in pair if r is not None]
    return train([r["text"] for r in found], [r["toxic"] for r in found], max(1.0, sizes.get(0, 0) / max(1, sizes.get(1, 0))))


class Shared:
    """A broadcast net with a name by which worker processes know it."""

    def __init__(self, net: Net, spark: SparkSession):
        self.id, self.sent = uuid.uuid4().hex, spark.sparkContext.broadcast(net)

    @property
    def value(self) -> Net:
        return self.sent.value


def scorer_of(shared: Shared) -> Scorer:
    """A worker keeps the inputs of its words from task to task, for one net at a time."""
    return kept(("net", shared.id), lambda: Scorer(shared.value, KEPT, WINDOWS))


def with_toxicity(docs: DataFrame, net: Net, name: str = "score") -> DataFrame:
    """All rows and columns and the toxicity of the whole text, 0 to 1. Null text is empty and scored as such.

    Every word and character of a text counts, whatever its length; a run of more than ``PIECE`` letters is read as several
    words that overlap. Repeated rows score alike; an empty table gives no rows; a column already called ``name`` is replaced.
    """
    shared = Shared(net, docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_of(shared)
        for texts in trimmed(batches):
            yield pd.Series(scorer.scores(texts.tolist()))

    return docs.withColumn(name, score(F.col("text")))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    net = learned(docs, table(spark, sf_dir, "labels"))
    held = F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)").alias("held_out")
    return with_toxicity(docs.select("doc_id", "text", held), net).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
