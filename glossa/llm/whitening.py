"""Embedding whitening by the exact characteristic polynomial of the scatter.

Entries become integers, so the scatter matrix n * sum(y y') - S S' is exact.  Its characteristic polynomial is computed
modulo many primes (Hessenberg reduction, one Spark row for each prime) and put together by Chinese remainders; the real
roots are isolated exactly, since of a polynomial with real roots alone the sign changes after a Taylor shift are the
number of roots beyond it; each root's null space comes from inverse iteration, corrected with exact residuals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm.common import partitions

#: What is added to floor(64 * entry); it cancels out of every result but the integers themselves.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Bits after the point of the roots and of the null vectors while they are corrected.
ROOT_BITS = 80
CORRECTIONS = 3
#: Sums travel in three limbs, the highest with the sign.
LIMB = 10 ** 15
#: Entries beyond this magnitude have no long at SCALE: their vectors are not usable.
MOST = 2.0 ** 56


# --- exact sums --------------------------------------------------------------------------------------------------
def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, ``embedding`` as doubles of the rows whose vector is not null and holds finite numbers of at most MOST alone."""
    x = F.col(column).cast("array<double>")
    fine = F.forall(x, lambda e: F.coalesce(F.abs(e) <= MOST, F.lit(False)))
    return vectors.where(F.col(column).isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(fine & (F.size("embedding") > 0))


def integers(column: pa.Array, d: int) -> np.ndarray:
    """floor(64 * entry) as longs, a row for each vector; SHIFT is left out."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * SCALE).astype(np.int64)


def exact_scatter(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers, in steps whose products are exact in doubles; larger entries go in two halves."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    if not len(y):
        return total
    most = max(int(np.abs(y).max()), 1)
    if most >= 1 << 25:
        high, low = y >> 24, y & ((1 << 24) - 1)
        cross = _products(high, low)
        return (exact_scatter(high) << 48) + ((cross + cross.T) << 24) + exact_scatter(low)
    step = max((1 << 53) // most ** 2, 1)
    for k in range(0, len(y), step):
        part = y[k:k + step].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b as Python integers; entries of any size."""
    most = max(int(np.abs(a).max()), 1), max(int(np.abs(b).max()), 1)
    if max(most) >= 1 << 25:
        high, low = (a >> 24, a & ((1 << 24) - 1)) if most[0] >= 1 << 25 else (b >> 24, b & ((1 << 24) - 1))
        return ((_products(high, b) << 24) + _products(low, b)) if most[0] >= 1 << 25 else ((_products(a, high) << 24) + _products(a, low))
    step = max((1 << 53) // (most[0] * most[1]), 1)
    total = np.zeros((a.shape[1], b.shape[1]), object)
    for k in range(0, len(a), step):
        total = total + (a[k:k + step].astype(float).T @ b[k:k + step].astype(float)).astype(np.int64).astype(object)
    return total


def _sums(d: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, column, sum of products) of the upper triangle; row -1 holds the sums, row -2 the count."""
        products, first, n = np.zeros((d, d), object), np.zeros(d, object), 0
        for batch in batches:
            y = integers(batch.column("embedding"), d)
            products, n = products + exact_scatter(y), n + len(y)
            first = first + _products(np.ones((len(y), 1), np.int64), y)[0] if len(y) else first
        if n:
            i, j = np.triu_indices(d)
            rows, cols = np.concatenate([[-2], np.full(d, -1), i]), np.concatenate([[0], np.arange(d), j])
            values = [n, *first.tolist(), *products[i, j].tolist()]
            limbs = [[v % LIMB for v in values], [v // LIMB % LIMB for v in values], [v // LIMB ** 2 for v in values]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), *(pa.array(x, pa.int64()) for x in limbs)],
                                             ["i", "j", "low", "middle", "high"])
    return sums


@dataclass
class Scatter:
    """n vectors, their sums S, and the matrix n * sum(y y') - S S', all exact; V is the matrix over n squared."""

    n: int
    sums: np.ndarray
    matrix: np.ndarray


def dimension(rows: DataFrame) -> int:
    """The commonest length of the vectors (the larger of two); 0 without vectors."""
    found = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def scatter(rows: DataFrame, d: int) -> Scatter:
    """Each partition sums its integers; d * d sums at most come to the driver, whatever the number of rows."""
    parts = rows.select("embedding").mapInArrow(_sums(d), "i int, j int, low long, middle long, high long")
    n, first, products = 0, np.zeros(d, object), np.zeros((d, d), object)
    limbs = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "middle", "high")]
    for r in parts.groupBy("i", "j").agg(*limbs).collect():
        v = int(r["low"]) + int(r["middle"]) * LIMB + int(r["high"]) * LIMB ** 2
        if r["i"] == -2:
            n = v
        elif r["i"] == -1:
            first[r["j"]] = v
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = v
    return Scatter(n, first, n * products - np.outer(first, first))


# --- characteristic polynomial -----------------------------------------------------------------------------------
def primes(bits: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product has more than ``bits`` bits."""
    sieve = np.ones(1 << 16, bool)
    sieve[:2] = False
    for p in range(2, 256):
        if sieve[p]:
            sieve[p * p::p] = False
    small = np.flatnonzero(sieve)
    out, have, p = [], 0.0, (1 << 31) - 1
    while have <= bits:
        if (p % small[small * small <= p]).all():
            out.append(p)
            have += np.log2(p)
        p -= 2
    return out


def characteristic_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, from x^0 up, of det(x - matrix) modulo the prime ``p`` < 2^31."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        pivot = np.flatnonzero(h[k + 1:, k])
        if not len(pivot):
            continue
        r = k + 1 + int(pivot[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)  # poly[k]: the polynomial of the leading k x k block
    poly[0, 0] = 1
    for k in range(1, d + 1):
        weigh = np.zeros(k, np.int64)  # of poly[i]: h[i, k - 1] times the subdiagonal between
        run = 1
        for i in range(k - 1, -1, -1):
            weigh[i] = int(h[i, k - 1]) * run % p
            run = run * int(h[i, i - 1]) % p if i else 0
        poly[k, 1:] = poly[k - 1, :-1]
        poly[k] = (poly[k] - (weigh[:, None] * poly[:k] % p).sum(0)) % p
    return poly[d]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The integer coefficients, from x^0 up, of det(x - matrix) of a symmetric, positive semidefinite matrix.

    Coefficient d - k is at most the k-th elementary symmetric function of equal roots, (d over k) * (trace / d)^k.
    """
    d = len(matrix)
    trace = int(np.trace(matrix))
    bits = d + d * max((trace // d + 1).bit_length(), 1) + 2
    chosen = primes(bits)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([characteristic_modulo(matrix, p).tolist()], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(partitions(spark), len(chosen))
    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(tasks, "p")
    product, out = 1, [0] * (d + 1)
    for r in sorted(table.mapInArrow(residues, "p long, c array<long>").collect()):
        p, inverse = r["p"], pow(product, -1, r["p"])
        out = [x + product * ((c - x) * inverse % p) for x, c in zip(out, r["c"])]
        product *= p
    return [x - product if 2 * x > product else x for x in out]


# --- roots -------------------------------------------------------------------------------------------------------
class Roots:
    """The roots of an integer polynomial all of whose roots are real and not negative."""

    def __init__(self, coefficients: list[int]):
        self.zeros = next((i for i, c in enumerate(coefficients) if c), len(coefficients) - 1)
        self.poly = coefficients[self.zeros:]  # without the roots at 0
        self._counts: dict[Fraction, int] = {}

    def beyond(self, at: Fraction) -> int:
        """How many roots (with multiplicity) are greater than ``at``: the sign changes of the coefficients of p(x + at)."""
        if at not in self._counts:
            a, b = at.numerator, at.denominator
            d = len(self.poly) - 1
            q = [c * b ** (d - i) for i, c in enumerate(self.poly)]  # b^d p(y / b): roots times b
            for i in range(d):
                for j in range(d - 1, i - 1, -1):
                    q[j] += a * q[j + 1]
            signs = [c > 0 for c in q if c]
            self._counts[at] = sum(x != y for x, y in zip(signs, signs[1:]))
        return self._counts[at]

    def _sign(self, at: Fraction) -> int:
        a, b = at.numerator, at.denominator
        value, power = 0, 1
        for c in reversed(self.poly):
            value, power = value * a + c * power, power * b
        return (value > 0) - (value < 0)

    def largest(self, n: int) -> list[tuple[Fraction, int]]:
        """(root, multiplicity) of the roots above 0, from the largest down, until ``n`` roots are covered.

        An interval is halved until it holds one root, or roots that are equal to ROOT_BITS bits; a single root is
        then narrowed by the sign of the polynomial.
        """
        total = len(self.poly) - 1
        top = Fraction(1)
        while self.beyond(top):
            top *= 2
        out: list[tuple[Fraction, int]] = []
        covered = 0
        todo = [(Fraction(0), top, total, 0)] if total else []  # (low, high, roots beyond low, beyond high): low < roots <= high
        while todo and covered < n:
            low, high, a, b = todo.pop()
            if a == b:
                continue
            if a - b == 1:
                out.append((self._narrow(low, high), 1))
                covered += 1
            elif low > 0 and (high - low) * (1 << ROOT_BITS) <= high:
                out.append(((low + high) / 2, a - b))
                covered += a - b
            else:
                middle = (low + high) / 2
                m = self.beyond(middle)
                todo += [(low, middle, a, m), (middle, high, m, b)]
        return out

    def _narrow(self, low: Fraction, high: Fraction) -> Fraction:
        """The single root in (low, high], to ROOT_BITS bits."""
        right = self._sign(high)
        if right == 0:
            return high
        while low == 0 or (high - low) * (1 << ROOT_BITS) > high:
            middle = (low + high) / 2
            s = self._sign(middle)
            if s == 0:
                return middle
            low, high = (low, middle) if s == right else (middle, high)
        return (low + high) / 2


# --- components --------------------------------------------------------------------------------------------------
def null_space(matrix: np.ndarray, root: Fraction, size: int, seed: int = 13) -> np.ndarray:
    """d x size: orthonormal vectors that matrix - root sends to 0, to double precision; each one's largest entry is positive.

    Inverse iteration in doubles finds them.  Then the residual of the vectors, as integers of ROOT_BITS more bits, is
    taken exactly and solved away in doubles, orthogonally to them; each correction adds the digits that doubles hold.
    """
    d = len(matrix)
    scale = max(int(np.trace(matrix)), 1)
    shifted = (matrix / scale).astype(float)
    shifted[np.diag_indices(d)] = [float((int(x) - root) / scale) for x in np.diag(matrix)]
    nudge = np.finfo(float).eps * d
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, size)))[0]
    for _ in range(4):
        v = np.linalg.qr(np.linalg.solve(shifted + nudge * np.eye(d), v))[0]
    if size < d:
        one = 1 << ROOT_BITS
        r = int(root * one)
        big = np.array([[int(x * 2.0 ** 60) << (ROOT_BITS - 60) for x in row] for row in v.tolist()], object).reshape(d, size)
        bordered = np.block([[shifted, v], [v.T, np.zeros((size, size))]])
        for _ in range(CORRECTIONS):
            residual = (matrix.dot(big) << ROOT_BITS) - big * r  # of (matrix - root) v, with 2 * ROOT_BITS bits
            small = np.array([[float(Fraction(int(x), scale << (2 * ROOT_BITS))) for x in row] for row in residual.tolist()]).reshape(d, size)
            step = np.linalg.solve(bordered, np.vstack([-small, np.zeros((size, size))]))[:d]
            big = big + np.array([[int(Fraction(x) * one) for x in row] for row in step.tolist()], object).reshape(d, size)
        v = np.array([[float(Fraction(int(x), one)) for x in row] for row in big.tolist()]).reshape(d, size)
        v = np.linalg.qr(v)[0] if size > 1 else v / np.linalg.norm(v)
    return v * np.sign(v[np.argmax(np.abs(v), axis=0), np.arange(size)])


@dataclass
class Whitening:
    """Components (columns of ``vectors``) by falling eigenvalue; ``roots`` are those of the scatter, n^2 times V's."""

    fit: Scatter
    vectors: np.ndarray
    roots: list[Fraction]

    @cached_property
    def explained(self) -> list[float]:
        trace = int(np.trace(self.fit.matrix))
        return [float(r / trace) for r in self.roots]

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S, exact: longs where they fit, Python integers where not."""
        n, sums = self.fit.n, self.fit.sums
        most = n * int(np.abs(y).max(initial=0)) + max(abs(int(s)) for s in sums)
        return n * y - sums.astype(np.int64) if most < 1 << 62 else n * y.astype(object) - sums

    def whiten(self, z: np.ndarray) -> np.ndarray:
        """x - S / n on the components, over the square root of V's eigenvalue: n cancels out."""
        roots = np.array([float(r) ** 0.5 for r in self.roots])
        return z.astype(float) @ (self.vectors / roots)


def fit(spark: SparkSession, rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The components of ``rows``; eigenvalue 0 has none, so there may be fewer than asked for."""
    s = scatter(rows, d)
    found = Roots(characteristic(spark, s.matrix)).largest(min(components, d)) if s.n else []
    vectors, roots = [np.zeros((d, 0))], []
    for root, size in found:
        vectors.append(null_space(s.matrix, root, size))
        roots += [root] * size
    return Whitening(s, np.concatenate(vectors, axis=1)[:, :components], roots[:components])


def _squares(z: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * z.shape[1] >= 1 << 63:
        z = z.astype(object)
    return (z * z).sum(1).tolist()


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(vec_id, deviation decimal, whitened array for every usable row, the model).

    Not usable, and dropped, are rows whose vector is null, empty, or holds a null, an entry that isn't finite or one
    beyond MOST; vectors of another than the commonest length are no rows of this table and are dropped too.  Repeated
    rows and ids count as often as they occur; a null vec_id is kept.  Without usable rows the result is empty and the
    model None.  A deviation beyond 38 digits is null.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    d = dimension(rows)
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    if not d:
        return spark.createDataFrame([], schema), None
    rows = rows.where(F.size("embedding") == d)
    model = fit(spark, rows, d, components)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = model.centred(integers(batch.column("embedding"), d))
            w = model.whiten(z)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([str(s) for s in _squares(z)]), lists], ["vec_id", "deviation", "whitened"])

    out = rows.mapInArrow(whiten, "vec_id long, deviation string, whitened array<double>")
    return out.withColumn("deviation", F.expr("try_cast(deviation AS decimal(38,0))")), model


def identity_error(out: DataFrame, components: int, n: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity; partitions sum, k * k sums meet."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components))
        for batch in batches:
            w = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            total += w.T @ w
        i, j = np.triu_indices(components)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    parts = out.select("whitened").mapInArrow(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    off = F.abs(F.col("v") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(parts.agg(F.max(off)).first()[0])


def whitened_components(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error: a row for each usable
    vector and component.  Odd rows are treated as ``whitened`` says; if all vectors are equal there are no components
    and no rows."""
    out, model = whitened(vectors, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not model.roots:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(out, len(model.roots), model.fit.n)
    rows = out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*[F.lit(e) for e in model.explained])
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.fit.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
