"""Whitened embeddings from an exact characteristic polynomial of their integer scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.session import written

#: Bits of one part of a number: products of two parts, summed over ``ROWS`` rows, are exact in a double.
PART, ROWS = 20, 1 << 12
#: Bits of the parts in which exact sums leave the tasks; as many parts as hold any sum of products of longs.
LIMB, LIMBS = 40, 6
FINE = "embedding is not null and size(embedding) > 0 and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('inf'))"
Polynomial = list[int]  # coefficients, highest power first
Interval = tuple[int, int, int]  # (a, b, s): from a / 2**s, not included, to b / 2**s


# Integers of a table


def integers(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """The rows with a usable vector and ``x``, its entries times ``scale``, floored, plus ``shift``; and ``dim``."""
    bound = F.lit(float(1 << 62))
    entry = lambda c: F.floor(F.greatest(-bound, F.least(bound, c.cast("double") * F.lit(float(scale))))) + F.lit(shift)
    return vectors.where(FINE).withColumn("x", F.transform("embedding", entry)).withColumn("dim", F.size("x"))


def _parts(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as doubles, ``sum(parts[k] << PART * k)``."""
    out = []
    while True:
        if np.abs(x).max(initial=0) < 1 << PART:
            return [*out, x.astype(float)]
        out.append((x & ((1 << PART) - 1)).astype(float))
        x = x >> PART


def _products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the rows and of their outer products, as arrays of Python numbers."""
    dim = x.shape[1]
    sums, outer = np.zeros(dim, object), np.zeros((dim, dim), object)
    for at in range(0, len(x), ROWS):
        parts = _parts(x[at : at + ROWS])
        for i, a in enumerate(parts):
            sums = sums + a.sum(axis=0).astype(np.int64).astype(object) * (1 << PART * i)
            for j, b in enumerate(parts):
                outer = outer + (a.T @ b).astype(np.int64).astype(object) * (1 << PART * (i + j))
    return sums, outer


def scatter(fit: DataFrame, dim: int, shift: int) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums ``S`` and the integer matrix ``n * sum(x x') - S S'`` of a table of vectors ``x``.

    Each task sums its rows exactly and hands over one row for each pair of dimensions, in parts that Spark sums as longs.
    Entries are taken less ``shift``, which changes neither the matrix nor, put back, the sums.
    """
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums, outer = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            x = np.stack(batch["x"].to_numpy()).astype(np.int64) - shift
            s, o = _products(x)
            n, sums, outer = n + len(x), sums + s, outer + o
        rows = [(-1, 0, n), *((-1, k + 1, v) for k, v in enumerate(sums)), *((i, j, outer[i, j]) for i, j in pairs)]
        low = (1 << LIMB) - 1
        limbs = [[(v >> LIMB * k) & low if k < LIMBS - 1 else v >> LIMB * k for k in range(LIMBS)] for _, _, v in rows]
        if n:
            yield pd.DataFrame([(i, j, *v) for (i, j, _), v in zip(rows, limbs, strict=True)], columns=["i", "j", *names])

    names = [f"v{k}" for k in range(LIMBS)]
    shape = "i int, j int, " + ", ".join(f"{v} long" for v in names)
    total = fit.select("x").mapInPandas(summed, shape).groupBy("i", "j").agg(*(F.sum(v).alias(v) for v in names)).collect()
    value = {(r["i"], r["j"]): sum(r[v] << LIMB * k for k, v in enumerate(names)) for r in total}
    n = value.get((-1, 0), 0)
    sums = [value.get((-1, k + 1), 0) for k in range(dim)]
    centred = [[n * value.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    return n, [s + n * shift for s in sums], centred


# The characteristic polynomial


def primes_below(top: int, many: int) -> list[int]:
    """The ``many`` largest primes below ``top``, an odd number."""
    sieve = np.ones(math.isqrt(top) + 1, bool)
    sieve[:2] = False
    for p in range(2, math.isqrt(len(sieve)) + 1):
        if sieve[p]:
            sieve[p * p :: p] = False
    small, out, width = np.flatnonzero(sieve), [], max(10_000, many * 40)
    while len(out) < many:
        block = np.arange(top - width, top, dtype=np.int64)
        fine = np.ones(width, bool)
        for p in small:
            fine[(-block[0]) % p :: p] = False
        out += [int(x) for x in block[fine][::-1]]
        top -= width
    return out[:many]


def hessenberg(matrix: list[list[int]], p: int) -> np.ndarray:
    """A matrix similar to ``matrix`` modulo the prime ``p``, zero below the first subdiagonal."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    for m in range(1, len(h) - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        k = m + int(below[0])
        if k != m:
            h[[m, k]] = h[[k, m]]
            h[:, [m, k]] = h[:, [k, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    return h


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of ``det(t - matrix)`` modulo the prime ``p`` (below 2**31), highest power first."""
    h, d = hessenberg(matrix, p), len(matrix)
    q = np.zeros((d + 1, d + 1), np.int64)  # q[k]: of the leading k rows, lowest power first
    q[0, 0] = 1
    for k in range(1, d + 1):
        q[k, 1:] = q[k - 1, :-1]
        q[k] = (q[k] - h[k - 1, k - 1] * q[k - 1]) % p
        product = 1
        for i in range(1, k):
            product = product * int(h[k - i, k - i - 1]) % p
            if not product:
                break
            q[k] = (q[k] - int(h[k - i - 1, k - 1]) * product % p * q[k - i - 1]) % p
    return [int(c) for c in q[d, ::-1]]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> Polynomial:
    """``det(t - matrix)`` of a symmetric matrix without negative eigenvalues, exact.

    A coefficient is at most a binomial number times a power of the trace; so many primes are taken that their product is
    more than twice that. Spark spreads the primes over tasks; each reduces the matrix by its primes, and the residues are
    joined by Chinese remainders.
    """
    d, trace = len(matrix), sum(matrix[k][k] for k in range(len(matrix)))
    bits = max((math.comb(d, k) * max(1, trace) ** k).bit_length() for k in range(d + 1)) + 2
    primes = primes_below((1 << 31) - 1, bits // 30 + 1)

    def residues(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [polynomial_modulo(matrix, int(p)) for p in batch["p"]]
            yield pd.DataFrame({"p": batch["p"], "c": got})

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInPandas(residues, "p long, c array<long>").collect()
    whole = math.prod(primes)
    out = [0] * (d + 1)
    for r in rows:
        other = whole // r["p"]
        unit = other * pow(other % r["p"], -1, r["p"])
        out = [(a + unit * c) % whole for a, c in zip(out, r["c"], strict=True)]
    return [c - whole if c > whole // 2 else c for c in out]


# Its roots


def _primitive(f: Polynomial) -> Polynomial:
    while len(f) > 1 and not f[0]:
        f = f[1:]
    content = reduce(math.gcd, f) or 1
    return [c // (content if f[0] > 0 else -content) for c in f]


def _remainder(f: Polynomial, g: Polynomial) -> Polynomial:
    """Of a multiple of ``f`` by ``g``."""
    f = list(f)
    while len(f) >= len(g):
        lead = f[0]
        f = [a * g[0] - (lead * g[k] if k < len(g) else 0) for k, a in enumerate(f)][1:]
    return f or [0]


def _divided(f: Polynomial, g: Polynomial) -> Polynomial:
    """``f / g`` up to a constant, where that is a polynomial."""
    f, out = list(f), []
    scale = g[0] ** (len(f) - len(g) + 1)
    f = [c * scale for c in f]
    while len(f) >= len(g):
        out.append(f[0] // g[0])
        f = [a - (out[-1] * g[k] if k < len(g) else 0) for k, a in enumerate(f)][1:]
    return _primitive(out)


def _derived(f: Polynomial) -> Polynomial:
    return [c * (len(f) - 1 - k) for k, c in enumerate(f[:-1])] or [0]


def _coprime_modulo(f: Polynomial, g: Polynomial, p: int) -> bool:
    a, b = ([c % p for c in h] for h in (f, g))
    while len(b) > 1 or b[0]:
        while len(b) > 1 and not b[0]:
            b = b[1:]
        if len(b) == 1:
            return bool(b[0])
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            lead = a[0] * inverse % p
            a = [(x - (lead * b[k] if k < len(b) else 0)) % p for k, x in enumerate(a)][1:]
        a, b = b, a or [0]
    return len(a) == 1


def simple_part(f: Polynomial) -> Polynomial:
    """The polynomial that has each root of ``f`` once."""
    g = _derived(f)
    if len(f) < 3 or _coprime_modulo(f, g, (1 << 61) - 1):
        return _primitive(f)
    a, b = _primitive(f), _primitive(g)
    while len(b) > 1 or b[0]:
        a, b = b, _primitive(_remainder(a, b)) if len(b) > 1 else [0]
    return _divided(_primitive(f), a)


def roots_above(f: Polynomial, a: int, s: int) -> int:
    """How many roots of ``f``, all real, are greater than ``a / 2**s``, each as often as it occurs.

    The changes of sign in the coefficients of ``f`` moved by that number: exact where all roots are real.
    """
    c = [v << s * k for k, v in enumerate(f)]
    for end in range(len(c), 1, -1):
        for k in range(1, end):
            c[k] += a * c[k - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_sign(f: Polynomial, a: int, s: int) -> int:
    total = 0
    for k, c in enumerate(f):
        total = total * a + (c << s * k)
    return (total > 0) - (total < 0)


def largest_roots(f: Polynomial, many: int, bits: int = 160) -> list[tuple[Interval, int]]:
    """Intervals that hold one positive root of ``f`` each, with how often it occurs, from the largest root down.

    Every root of ``f`` must be real. Intervals are halved by counting the roots above their middle until each holds one
    root, then by the sign at the middle, until one is 2**-``bits`` of its root and of its distance from the next. Roots are
    listed until ``many`` are found, counted as often as they occur.
    """
    f = _primitive(f)
    while len(f) > 1 and not f[-1]:
        f = f[:-1]  # roots of zero
    once = simple_part(f)
    top = 1
    while len(once) > 1 and roots_above(once, 1 << top, 0):
        top *= 2
    open_ = [(0, 1 << top, 0, roots_above(once, 0, 0), 0)] if len(once) > 1 else []
    found: list[tuple[Interval, int]] = []
    while open_ and sum(n for _, n in found) < many:
        a, b, s, at_a, at_b = open_.pop()
        if at_a - at_b == 1:
            found.append(((a, b, s), roots_above(f, a, s) - roots_above(f, b, s)))
            continue
        a, b, s = 2 * a, 2 * b, s + 1
        middle = (a + b) // 2
        at_middle = roots_above(once, middle, s)
        for part in ((a, middle, s, at_a, at_middle), (middle, b, s, at_middle, at_b)):
            if part[3] > part[4]:
                open_.append(part)
    # The next root below bounds the last distance.
    others = [x for x, _ in found] + [(a, b, s) for a, b, s, _, _ in open_[-1:]]
    narrow = [_narrowed(once, x, bits) for x in others[: len(found)]]
    for k, (a, b, s) in enumerate(narrow):
        gaps = [abs(_middle(others[j]) - _middle((a, b, s))) for j in (k - 1, k + 1) if 0 <= j < len(others)]
        extra = max([0, *(math.ceil(math.log2(_middle((a, b, s)) / g)) for g in gaps if g)])
        if extra:
            narrow[k] = _narrowed(once, (a, b, s), bits + extra)
    return [(x, n) for x, (_, n) in zip(narrow, found, strict=True)]


def _middle(x: Interval) -> Decimal:
    with localcontext(Context(prec=400)):
        return Decimal(x[0] + x[1]) / Decimal(2 ** (x[2] + 1))


def _narrowed(once: Polynomial, x: Interval, bits: int) -> Interval:
    a, b, s = x
    high = value_sign(once, b, s)
    if not high:
        return (b << bits + 2) - 1, b << bits + 2, s + bits + 2
    while (b - a) << bits > b:
        a, b, s = 2 * a, 2 * b, s + 1
        sign = value_sign(once, middle := (a + b) // 2, s)
        if not sign:
            return (middle << bits + 2) - 1, middle << bits + 2, s + bits + 2
        a, b = (a, middle) if sign == high else (middle, b)
    return a, b, s


# Its vectors


def null_vectors(matrix: list[list[int]], root: Interval, many: int, seed: int = 11) -> list[list[Decimal]]:
    """``many`` orthonormal vectors that ``matrix`` less the root, which occurs so often, takes to zero.

    The matrix less the middle of the root's interval is eliminated with pivots in as many digits as the interval has, and
    random vectors are solved for twice: what does not belong to the root shrinks by the interval over the distance.
    """
    digits = math.ceil((max(root[1], 1).bit_length()) * 0.30103) + 60
    with localcontext(Context(prec=digits)):
        d, mu = len(matrix), Decimal(root[0] + root[1]) / Decimal(2 ** (root[2] + 1))
        m = np.array([[Decimal(v) - (mu if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)], object)
        draw = np.random.default_rng(seed)
        y = np.array([[Decimal(int(v)) for v in row] for row in draw.integers(1, 1000, (d, many))], object)
        steps = []
        for k in range(d):
            best = k + int(np.argmax(np.abs(m[k:, k]).astype(object)))
            m[[k, best]] = m[[best, k]]
            factors = m[k + 1 :, k] / m[k, k]
            m[k + 1 :, k:] -= factors[:, None] * m[k, k:]
            steps.append((k, best, factors))
        for _ in range(2):
            for k, best, factors in steps:
                y[[k, best]] = y[[best, k]]
                y[k + 1 :] -= factors[:, None] * y[k]
            for k in range(d - 1, -1, -1):
                y[k] = (y[k] - (m[k, k + 1 :, None] * y[k + 1 :]).sum(axis=0)) / m[k, k] if k < d - 1 else y[k] / m[k, k]
            for c in range(many):
                for _ in range(2):
                    for e in range(c):
                        y[:, c] -= (y[:, c] * y[:, e]).sum() * y[:, e]
                    y[:, c] /= (y[:, c] * y[:, c]).sum().sqrt()
        return [list(y[:, c]) for c in range(many)]


class Whitening:
    """Components and eigenvalues of the covariance of integer vectors; every number in it comes from exact sums."""

    def __init__(self, n: int, sums: list[int], matrix: list[list[int]], polynomial: Polynomial, components: int):
        self.n, self.sums, self.dim = n, sums, len(sums)
        trace = sum(matrix[k][k] for k in range(self.dim))
        values: list[float] = []
        explained: list[float] = []
        vectors: list[np.ndarray] = []
        for root, times in largest_roots(polynomial, components):
            for v in null_vectors(matrix, root, times):
                out = np.array([float(x) for x in v])
                vectors.append(out if out[np.argmax(np.abs(out))] > 0 else -out)
                values.append(float(_middle(root) / Decimal(n) / Decimal(n)))
                explained.append(float(_middle(root) / Decimal(trace)))
        self.values, self.explained = values[:components], explained[:components]
        self.vectors = np.array(vectors[:components]).reshape(len(self.values), self.dim)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: longs where they fit, else Python numbers."""
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        if most < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, y: np.ndarray) -> list[int]:
        if y.dtype != object and self.dim * int(np.abs(y).max(initial=0)) ** 2 < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        return [int(v) for v in (y.astype(object) ** 2).sum(axis=1)] if len(y) else []

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y / self.n).astype(float) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def _without_content(matrix: list[list[int]]) -> tuple[int, list[list[int]]]:
    content = reduce(math.gcd, (v for row in matrix for v in row), 0) or 1
    return content, [[v // content for v in row] for row in matrix]


def fitted(spark: SparkSession, fit: DataFrame, dim: int, components: int = 16, shift: int = 1_000_000) -> Whitening:
    """The whitening of a table of integer vectors ``x`` of ``dim`` entries."""
    n, sums, matrix = scatter(fit, dim, shift)
    content, small = _without_content(matrix)
    polynomial = characteristic_polynomial(spark, small) if any(v for row in small for v in row) else [1] + [0] * dim
    # Roots and vectors are those of the smaller matrix; the content scales the roots back.
    out = Whitening(n, sums, small, polynomial, components)
    out.values = [v * content for v in out.values]
    return out


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list less the identity."""
    many = len(model.values)
    if not many:
        return 0.0
    shared = fit.sparkSession.sparkContext.broadcast(model)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, model = np.zeros((many + 1, many)), shared.value
        for batch in batches:
            w = model.whitened(model.centred(np.stack(batch["x"].to_numpy()).astype(np.int64)))
            total[:many] += w.T @ w
            total[many] += w.sum(axis=0)
        yield pd.DataFrame([(i, j, total[i, j]) for i in range(many + 1) for j in range(many)], columns=["i", "j", "v"])

    got = np.zeros((many + 1, many))
    for r in fit.select("x").mapInPandas(summed, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        got[r["i"], r["j"]] = r["v"] / model.n
    return float(np.abs(got[:many] - np.outer(got[many], got[many]) - np.eye(many)).max())


WHITENED = "n long, deviation long, deviation_digits string, whitened array<double>, explained array<double>, identity_error double"


def with_whitened(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, name: str = "whitening") -> DataFrame:
    """The rows with a usable vector, all their columns and the struct ``name``: its projections on the principal components.

    Entries become integers (times ``scale``, floored, plus ``shift``), and the fit list is each distinct integer vector once.
    Its scatter is summed exactly; the characteristic polynomial comes from Hessenberg reductions modulo primes, which
    Spark spreads over tasks; its largest roots are isolated by counting sign changes and narrowed to 160 bits and more; and
    the components solve for the null space in as many digits. Equal eigenvalues give orthonormal components of their space.

    ``deviation`` is the sum of ``(n * x - S)**2``, null beyond the range of longs (past some ten million different
    vectors); ``deviation_digits`` holds it whole. Rows that are null or hold null or non-finite entries are left out, as are
    vectors of any length but the commonest (ties: the longer). Eigenvalues of zero have no component: a single
    vector, or copies of one, have none at all. Entries beyond ``2**62`` become that. An empty vector is not usable. Repeated rows are fitted once
    and returned as often as they come. A column already called ``name`` is replaced; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    own = [c for c in vectors.columns if c != name]
    rows = vectors.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), "embedding")
    rows = integers(rows, scale, shift).drop("embedding")
    lengths = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    rows = rows.where(F.col("dim") == dim)
    fit = written(rows.select("x").distinct(), "different_vectors")
    model = fitted(spark, fit, dim, components, shift)
    error = identity_error(fit, model)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(WHITENED)
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            y = model.centred(np.array(batch.tolist(), np.int64).reshape(len(batch), model.dim))
            exact = model.deviations(y)
            out = pd.DataFrame({"n": np.full(len(batch), model.n, np.int64)})
            out["deviation"] = pd.array([v if v < 1 << 63 else None for v in exact], "Int64")
            out["deviation_digits"] = list(map(str, exact))
            out["whitened"] = list(model.whitened(y)) if model.values else [np.zeros(0)] * len(batch)
            out["explained"] = [model.explained] * len(batch)
            out["identity_error"] = error
            yield out

    return rows.select("row", project(F.col("x")).alias("w")).select("row.*", F.col("w").alias(name))


def op11_whitening(spark, sf_dir):
    """A row for each usable vector and component."""
    rows = with_whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = rows.select("vec_id", "whitening.*").withColumn("each", F.arrays_zip("whitened", "explained"))
    each = each.select("vec_id", "n", "deviation", "deviation_digits", "identity_error", F.posexplode("each").alias("at", "of"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error", "deviation_digits",
    )
