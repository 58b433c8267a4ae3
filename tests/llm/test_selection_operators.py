"""Line dedup, resampling and whitening against brute force, with nulls, ties, repeated rows, long texts and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check import normalised
from millrace.llm import linededup, resample, whitening
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, lang string, hash string, place long, row string, score double, tie int, by string"
FIXED = ("x", "h", 1, "r", 0.5, 2, "b")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got, expected = normalised(QUERIES[name](spark, SF).toPandas()), normalised(con.execute(ORACLES[name]).df())
    assert list(got.columns) == list(expected.columns) and len(got) and got.equals(expected)


# Line dedup


def kept_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc_id is not None:
                held[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held[key(x)]) < min_docs or doc_id == max(held[key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def lined(spark):
    draw = np.random.default_rng(3)
    common = [f"a line that many documents repeat, number {k}" for k in range(8)] + ["short", "ÄÖÜ mixed Ünicode line of some length", "  not stripped of this space  "]
    texts = []
    for k in range(60):
        lines = [common[j] for j in draw.integers(0, len(common), 6)] + [f"only here {k} and nowhere else {j}" for j in range(4)]
        lines = [f"  {x.upper()}\t" if draw.random() < 0.3 else x for x in draw.permutation(lines)]
        texts.append("\n".join(lines))
    texts += [None, "", "\n", "\n\n", common[0], "\n".join([common[1]] * 5000 + [f"row {k} of a very long document" for k in range(20_000)]), "x" * 300_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (4, "another text of document four\n" + common[2]), (None, texts[5]), (None, None)]
    return spark.createDataFrame([(i, t, *FIXED) for i, t in rows], CLASHING).repartition(4), rows


def test_line_dedup(lined):
    docs, rows = lined
    got = linededup.without_repeated_lines(docs)
    assert got.columns == [*docs.columns, "lines"]
    assert sorted(((r.doc_id, r.lines.n_lines, r.lines.n_dropped, r.lines.text) for r in got.collect()), key=repr) == kept_lines(rows)
    fewer = linededup.without_repeated_lines(docs, 5, 2, name="hash").select("doc_id", "hash.*")
    assert sorted(map(tuple, fewer.collect()), key=repr) == kept_lines(rows, 5, 2)
    assert linededup.without_repeated_lines(docs.where("false")).count() == 0


def test_line_dedup_by_shuffles(spark, lined, monkeypatch):
    monkeypatch.setattr(linededup, "small_enough", lambda df: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_line_dedup(lined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Resampling


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def drawn(rows, target, percent=25):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for doc_id, text in rows:
        n, f = features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=repr)


@pytest.fixture(scope="module")
def wordy(spark):
    draw = np.random.default_rng(4)
    words = [f"Word{k}" for k in range(300)] + ["ÉTÉ", "naïve", "中文", "x-y", "_"]
    rows = [(k, " ".join(draw.choice(words, int(n)))) for k, n in enumerate(draw.integers(1, 90, 400))]
    rows += [(1000, None), (1001, ""), (1002, "... !!"), (1003, "a" * 3_000_000 + " b"), (None, rows[0][1]), (-5, rows[1][1])]
    rows += [(7, rows[7][1])] * 40
    target = [" ".join(draw.choice(words[:60], 30)) for _ in range(20)] + [None, ""]
    return rows, target


def test_resampling(spark, wordy, monkeypatch):
    rows, target = wordy
    docs = spark.createDataFrame([(i, t, *FIXED) for i, t in rows], CLASHING).repartition(5)
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    got = resample.resampled(docs, bench)
    assert got.columns == [*docs.columns, "draw"]
    fields = "draw.n_words, draw.n_features, draw.weight, draw.score, draw.rank".split(", ")
    assert sorted(map(tuple, got.select("doc_id", *fields).collect()), key=repr) == drawn(rows, target)
    monkeypatch.setattr(resample, "SLICE", 100)
    assert sorted(map(tuple, resample.resampled(docs, bench, 100, name="score").select("doc_id", *(f.replace("draw", "score") for f in fields)).collect()), key=repr) == drawn(rows, target, 100)
    assert resample.resampled(docs.where("false"), bench).count() == 0
    assert {r.draw.weight for r in resample.resampled(docs, bench.where("false")).select("draw").collect()} != {0}
    assert resample.resampled(docs, bench, 0).where("draw.rank is not null").count() == 0


@pytest.mark.parametrize("kind", ["spread", "equal", "sorted", "two values"])
def test_nth_largest(spark, kind):
    draw = np.random.default_rng(5)
    n = 3000
    score = {"spread": draw.integers(-1000, 1000, n), "equal": np.zeros(n, int), "sorted": np.arange(n), "two values": draw.integers(0, 2, n)}[kind]
    tie = draw.integers(0, 50, n)
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in zip(score, tie, strict=True)], "score long, tie long").repartitionByRange(6, "score")
    expected = sorted(zip(score.tolist(), tie.tolist(), strict=True), reverse=True)
    for k in (1, 2, n // 4, n - 1, n):
        assert resample.nth_largest(rows, k) == expected[k - 1]
    assert resample.nth_largest(rows, 0) is None and resample.nth_largest(rows, n + 1) is None


def test_a_round_discards_a_quarter():
    """However rows are dealt to tasks, at most three quarters lie on either side of the weighted median of medians."""
    draw = np.random.default_rng(8)
    for _ in range(200):
        tasks = [sorted((int(v), 0) for v in draw.integers(0, 10 ** int(draw.integers(1, 6)), int(draw.integers(1, 40)))) for _ in range(int(draw.integers(1, 12)))]
        pivot = resample.weighted_median([(t[len(t) // 2], len(t)) for t in tasks])
        rows = [r for t in tasks for r in t]
        assert sum(r > pivot for r in rows) <= 0.75 * len(rows) and sum(r < pivot for r in rows) <= 0.75 * len(rows) + len(tasks)


# Whitening


def whitened(spark, vectors, **columns):
    rows = [(k, [float(c) for c in v], *columns.values()) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def fitted(vectors, components=16):
    """By numpy: distinct integer vectors, their eigenvalues from the largest down, and the vectors."""
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    c = u - u.sum(axis=0) / len(u)
    values, basis = np.linalg.eigh(c.T @ c / len(u))
    return x, u, values[::-1][:components], basis[:, ::-1][:, :components]


def test_whitening(spark):
    draw = np.random.default_rng(2)
    vectors = (draw.normal(0, 1, (300, 24)) @ np.diag(np.linspace(0.2, 3, 24))).tolist()
    vectors += vectors[:20] + [vectors[0]] * 200
    frame = spark.createDataFrame(
        [(k, v, "w", 1, 2) for k, v in enumerate(vectors)]
        + [(900, None, "n", 1, 2), (901, [1.0] * 23 + [None], "n", 1, 2), (902, [float("nan")] * 24, "n", 1, 2), (903, [float("inf")] * 24, "n", 1, 2), (904, [1.0], "short", 1, 2), (905, [], "empty", 1, 2)],
        "vec_id long, embedding array<double>, x string, n int, row int",
    ).repartition(4)
    got = whitening.with_whitened(frame)
    assert got.columns == [*frame.columns, "whitening"]
    rows = {r.vec_id: r.whitening for r in got.collect()}
    x, u, values, basis = fitted(vectors)
    assert set(rows) == set(range(len(vectors)))
    W = np.array([rows[k].whitened for k in range(len(vectors))])
    expected = (x - u.sum(axis=0) / len(u)) @ basis / np.sqrt(values)
    assert np.abs(W - expected * np.sign((W * expected).sum(axis=0))).max() < 1e-8
    trace = np.trace(np.cov(u.T, bias=True))
    assert all(r.n == len(u) and r.identity_error < 1e-9 and np.allclose(r.explained, values / trace, rtol=1e-9) for r in rows.values())
    S = u.sum(axis=0)
    assert all(rows[k].deviation == sum((len(u) * int(a) - int(b)) ** 2 for a, b in zip(x[k], S, strict=True)) == int(rows[k].deviation_digits) for k in range(0, len(vectors), 37))


def test_whitening_of_equal_eigenvalues(spark):
    """The vectors of a cube's corners and of two crosses: every eigenvalue occurs more than once, some are zero."""
    corners = [[a, b, c, 0, 0, 0, 5] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    crosses = [[0, 0, 0, s * (k == 3), s * (k == 4), 0, 5] for k in (3, 4) for s in (-2, 2)]
    rows = whitening.with_whitened(whitened(spark, corners + crosses)).collect()
    W = np.array([r.whitening.whitened for r in rows])
    assert W.shape == (12, 5) and np.abs(W.T @ W / 12 - np.eye(5)).max() < 1e-12
    assert rows[0].whitening.identity_error < 1e-12 and abs(sum(rows[0].whitening.explained) - 1) < 1e-12


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 9])
def test_whitening_without_spread(spark, vectors):
    rows = whitening.with_whitened(whitened(spark, vectors)).collect()
    assert len(rows) == len(vectors) and all(list(r.whitening.whitened) == [] and r.whitening.deviation == 0 and r.whitening.identity_error == 0 for r in rows)


def test_whitening_of_huge_entries(spark):
    """Sums far beyond longs stay exact; the deviation has only its digits."""
    vectors = [[1e15, 3.0], [-1e15, 4.0], [1e300, 5.0], [2e14, -7.5]]
    rows = {r.vec_id: r.whitening for r in whitening.with_whitened(whitened(spark, vectors)).collect()}
    x = [[min(int(Fraction(c) * 64 // 1), 1 << 62) + 1_000_000 for c in v] for v in vectors]
    S = [sum(c) for c in zip(*x, strict=True)]
    for k, v in enumerate(x):
        assert int(rows[k].deviation_digits) == sum((4 * a - b) ** 2 for a, b in zip(v, S, strict=True)) and rows[k].deviation is None


def test_scatter_is_exact(spark):
    draw = np.random.default_rng(9)
    x = np.concatenate([draw.integers(-(1 << 61), 1 << 61, (50, 3)), draw.integers(-9, 9, (5000, 3))])
    frame = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>").repartition(5)
    n, sums, matrix = whitening.scatter(frame, 3, 1_000_000)
    big = x.astype(object)
    S = big.sum(axis=0)
    assert n == len(x) and sums == list(S) and matrix == (n * (big.T @ big) - np.outer(S, S)).tolist()


def test_characteristic_polynomial(spark):
    """Against Faddeev and LeVerrier's recurrence in whole numbers, zeros on the subdiagonal among them."""
    draw = np.random.default_rng(7)
    for d, rank in ((1, 1), (2, 2), (6, 6), (9, 4)):
        a = draw.integers(-9, 9, (rank, d)).astype(object)
        a[:, d // 2] = 0
        m = (a.T @ a).tolist()
        M, c, out = np.zeros((d, d), object), 1, [1]
        for k in range(1, d + 1):
            M = np.array(m, object) @ M + c * np.eye(d, dtype=int).astype(object)
            c = -int(np.trace(np.array(m, object) @ M)) // k
            out.append(c)
        assert whitening.characteristic_polynomial(spark, m) == out


def test_roots():
    """Roots 1/3, 7 twice, 7 + 10**-30, 0 three times."""
    factors = [[3, -1], [1, -7], [1, -7], [10**30, -7 * 10**30 - 1], [1, 0], [1, 0], [1, 0]]
    f = [1]
    for g in factors:
        f = [sum(f[i] * g[k - i] for i in range(len(f)) if 0 <= k - i < len(g)) for k in range(len(f) + len(g) - 1)]
    got = whitening.largest_roots(f, 9)
    assert [n for _, n in got] == [1, 2, 1]
    for ((a, b, s), _), root in zip(got, [7 + Fraction(1, 10**30), Fraction(7), Fraction(1, 3)], strict=True):
        assert Fraction(a, 2**s) < root <= Fraction(b, 2**s) and Fraction(b - a, 2**s) < root / 2**150
    assert len(whitening.largest_roots(f, 1)) == 1 and whitening.largest_roots([1, 0, 0], 4) == []


def test_columns_of_whitening(spark):
    rows = QUERIES["op11_whitening"](spark, SF)
    assert {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"} <= set(rows.columns)
    each = rows.groupBy("vec_id").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n")).drop("vec_id").distinct()
    assert [tuple(r) for r in each.collect()] == [(1, 16, 16)]
