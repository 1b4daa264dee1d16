"""Whitening of embeddings by the exact characteristic polynomial.

Vectors become integers, and everything about their scatter stays exact:

1. One pass sums the integer scatter: every task multiplies its vectors in
   limbs of 14 bits, so that no floating product is rounded, and the sums over
   tasks are decimals of 38 digits. A = n * sum(x x') - S S' is n * n times the
   covariance, in integers.
2. The characteristic polynomial of A is reduced to Hessenberg form modulo as
   many 31-bit primes as its coefficients need (bounded by Maclaurin's
   inequality from the trace), one prime after the other in Spark tasks, and put
   together by the Chinese remainder theorem. One more prime checks it.
3. All its roots are real, so the sign changes of its coefficients, shifted to
   a point, count the roots beyond that point exactly: bisection isolates every
   root, and refines it to a relative width of 2**-WIDTH.
4. A component is the null space of A - root * I: inverse iteration by an LU
   decomposition in fixed-point integers, one Spark task per group of equal roots.
5. A second pass sums the covariance of the whitened rows (the identity error),
   a third one returns the rows.

Only the scatter and what follows from it, whose sizes depend on the number of
dimensions alone, reach the driver.

Edge cases: rows with a null vector or a null or non-finite entry are dropped
and are not fitted on; entries that a shorter vector lacks count as 0; a scaled
entry beyond 2**40 counts as 2**40; a null id stays a row; a deviation beyond a
long is null; directions without any variance have components whose whitened value is
null and whose explained share is 0 (null if no direction has variance); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.frames import stored
from blotter.llm.vectors import finite_vectors, matrix, width_of

SCALE, COMPONENTS = 64, 32
LIMIT = float(1 << 40)
LIMB = 14
#: Relative width of a root's interval, and from where roots count as equal.
WIDTH, EQUAL = 160, 128
#: Fraction bits of the fixed-point decomposition.
FRACTION = 256
SLICE = 2048


def scaled(column: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * entry); a constant added to all entries of a dimension, as
    the million of the contract, changes neither scatter nor deviation."""
    return np.clip(np.floor(SCALE * matrix(column, width)), -LIMIT, LIMIT)


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers; ``y`` holds integers of up to 2**41."""
    limbs, rest = [], y.astype(np.int64)
    while True:
        low = rest & ((1 << LIMB) - 1)
        if np.abs(rest).max(initial=0) < 1 << LIMB:
            limbs.append(rest.astype(np.float64))
            break
        limbs.append(low.astype(np.float64))
        rest = rest >> LIMB
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(rows, sum per dimension, sum of products) of the scaled vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 13):
                y = scaled(batch.column(0).slice(start, 1 << 13), width)
                n += len(y)
                sums += y.astype(np.int64).sum(0).astype(object)
                products += _exact_gram(y)
        if n:
            rows = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums.tolist()))]
            rows += [(i, j, products[i, j]) for i in range(width) for j in range(i, width)]
            i, j, v = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(int(x)) for x in v])], names=["i", "j", "v"])

    parts = vectors.select("embedding").mapInArrow(run, "i int, j int, v string")
    found = {(r.i, r.j): int(r.v) for r in parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    n = found.pop((-1, -1), 0)
    sums = [found.get((i, -1), 0) for i in range(width)]
    return n, sums, [[found.get((min(i, j), max(i, j)), 0) for j in range(width)] for i in range(width)]


def primes(count: int) -> list[int]:
    """The largest primes below 2**31."""

    def prime(n: int) -> bool:
        if any(n % p == 0 for p in (3, 5, 7, 11, 13)):
            return False
        odd = n - 1
        twos = (odd & -odd).bit_length() - 1
        odd >>= twos
        for base in (2, 3, 5, 7):  # decides all numbers below 3.2e9
            x = pow(base, odd, n)
            if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
                return False
        return True

    out, n = [], (1 << 31) - 1
    while len(out) < count:
        if prime(n):
            out.append(n)
        n -= 2
    return out


def charpoly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of det(x I - a) modulo ``p`` < 2**31, from
    the Hessenberg form of ``a`` (entries from 0 to p - 1)."""
    h, d = a.copy(), len(a)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[pivot, k + 1]] = h[[k + 1, pivot]]
            h[:, [pivot, k + 1]] = h[:, [k + 1, pivot]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :, k:] = (h[k + 2 :, k:] - factor[:, None] * h[k + 1, k:] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(1)) % p
    # leading[k]: polynomial of the k x k corner
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        weight, along = np.zeros(k, np.int64), 1
        weight[k - 1] = h[k - 1, k - 1]
        for m in range(k - 2, -1, -1):
            along = along * int(h[m + 1, m]) % p
            weight[m] = int(h[m, k - 1]) * along % p
        leading[k, 1:] = leading[k - 1, :-1]
        leading[k] = (leading[k] - (weight[:, None] * leading[:k] % p).sum(0)) % p
    return leading[d]


def charpoly(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(x I - a) of an integer matrix
    without negative eigenvalues."""
    d = len(a)
    trace = sum(a[i][i] for i in range(d))
    # the k-th coefficient is a sum over k eigenvalues: C(d, k) * (trace / d)**k at most
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    used = primes((2 * bound).bit_length() // 30 + 2)
    text = [[str(x) for x in row] for row in a]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        whole = np.array([[int(x) for x in row] for row in text], object)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                values = charpoly_mod((whole % p).astype(np.int64), p).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([values], pa.list_(pa.int64()))], names=["p", "c"])

    listed = spark.createDataFrame([(p,) for p in used], "p long").repartition(min(len(used), spark.sparkContext.defaultParallelism))
    residues = {r.p: r.c for r in listed.mapInArrow(run, "p long, c array<long>").collect()}
    check, *rest = used
    modulus = math.prod(rest)
    weights = [modulus // p * pow(modulus // p, -1, p) for p in rest]
    out = []
    for k in range(d + 1):
        x = sum(residues[p][k] * w for p, w in zip(rest, weights, strict=True)) % modulus
        out.append(x - modulus if 2 * x > modulus else x)
    if any(c % check != r for c, r in zip(out, residues[check], strict=True)):
        raise ArithmeticError("the characteristic polynomial fails its check prime")
    return out


@dataclass(frozen=True)
class Root:
    """A root between at / 2**bits and (at + 1) / 2**bits, so many times."""

    at: int
    bits: int
    times: int

    def value(self) -> float:
        return (2 * self.at + 1) / (1 << (self.bits + 1))


def _beyond(c: list[int], at: int, bits: int) -> int:
    """How many roots of ``c`` (all real) exceed at / 2**bits: sign changes of
    the polynomial shifted there."""
    d = len(c) - 1
    shifted = [x << (bits * (d - k)) for k, x in enumerate(c)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            shifted[j] += at * shifted[j + 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(c: list[int], at: int, bits: int) -> int:
    """Sign of ``c`` at at / 2**bits."""
    d, total = len(c) - 1, 0
    for k in range(d, -1, -1):
        total = total * at + (c[k] << (bits * (d - k)))
    return (total > 0) - (total < 0)


def real_roots(c: list[int]) -> list[Root]:
    """The positive roots of ``c``, constant first, whose roots are all real
    and not negative, from the largest. Roots of 0 are left out."""
    zeros = next(k for k, x in enumerate(c) if x)
    c = c[zeros:]
    d = len(c) - 1
    if not d:
        return []
    top = 1 << max(0, (abs(c[-2]) + 1).bit_length())  # the sum of the roots
    out = []
    # (at, width) in units of 2**-bits, roots beyond its lower and its upper end
    open_ = [(0, top, 0, d, 0)]
    while open_:
        at, width, bits, low, high = open_.pop()
        times = low - high
        if not times:
            continue
        if width > 1 or at.bit_length() < 8:
            if width == 1:
                at, width, bits = 2 * at, 2, bits + 1
            half = width // 2
            mid = _beyond(c, at + half, bits)
            open_ += [(at, half, bits, low, mid), (at + half, half, bits, mid, high)]
        elif times == 1:
            before = -1 if low % 2 else 1  # the sign just above the lower end
            while at.bit_length() < WIDTH:
                at, bits = 2 * at, bits + 1
                now = _sign(c, at + 1, bits)
                if now == before:
                    at += 1
                elif not now:  # the root itself, an upper end
                    at, bits = ((at + 1) << WIDTH) - 1, bits + WIDTH
            out.append(Root(at, bits, 1))
        elif at.bit_length() < EQUAL:
            mid = _beyond(c, 2 * at + 1, bits + 1)
            open_ += [(2 * at, 1, bits + 1, low, mid), (2 * at + 1, 1, bits + 1, mid, high)]
        else:
            out.append(Root(at, bits, times))
    return sorted(out, key=lambda r: -r.value())


def null_space(a: list[list[int]], root: Root) -> np.ndarray:
    """``root.times`` orthonormal rows v with a v = root v."""
    d, one = len(a), 1 << FRACTION
    shift = (2 * root.at + 1) << (FRACTION - root.bits - 1) if FRACTION > root.bits else (2 * root.at + 1) >> (root.bits + 1 - FRACTION)
    rows = [np.array([x << FRACTION for x in row], object) for row in a]
    for i in range(d):
        rows[i][i] -= shift
    order, factors = list(range(d)), []
    for k in range(d):
        p = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[p], order[k], order[p] = rows[p], rows[k], order[p], order[k]
        if factors:
            for f in factors:
                f[k], f[p] = f[p], f[k]
        if not rows[k][k]:
            rows[k][k] = 1
        column = [0] * d
        for i in range(k + 1, d):
            column[i] = (rows[i][k] << FRACTION) // rows[k][k]
            if column[i]:
                rows[i][k:] = rows[i][k:] - (column[i] * rows[k][k:] >> FRACTION)
        factors.append(column)

    def solve(b: list[int]) -> list[int]:
        x = [b[i] for i in order]
        for k in range(d):
            for i in range(k + 1, d):
                if factors[k][i]:
                    x[i] -= factors[k][i] * x[k] >> FRACTION
        for k in range(d - 1, -1, -1):
            x[k] = ((x[k] << FRACTION) - int((rows[k][k + 1 :] * np.array(x[k + 1 :], object)).sum() if k + 1 < d else 0)) // rows[k][k]
        return x

    def unit(x: list[int], others: list[list[int]]) -> list[int]:
        for _ in range(2):
            for o in others:
                part = sum(i * j for i, j in zip(x, o, strict=True)) >> FRACTION
                x = [i - (part * j >> FRACTION) for i, j in zip(x, o, strict=True)]
            length = math.isqrt(sum(i * i for i in x)) or 1
            x = [(i << FRACTION) // length for i in x]
        return x

    rng = np.random.default_rng(11)
    basis = [[int(v) << (FRACTION - 32) for v in rng.integers(1 << 30, 1 << 32, d)] for _ in range(root.times)]
    for _ in range(3):
        made: list[list[int]] = []
        for x in basis:
            made.append(unit(solve(x), made))
        basis = made
    out = np.array([[v / one for v in x] for x in basis])
    return out * np.where(out[np.arange(len(out)), np.abs(out).argmax(1)] < 0, -1.0, 1.0)[:, None]


@dataclass
class Whitening:
    """n rows with the given sums per dimension; unit ``axes`` (one row each)
    with eigenvalues ``power`` of n * n times the covariance, falling; ``count``
    components are asked for, of which those beyond ``axes`` have no variance."""

    n: int
    sums: list[int]
    trace: int
    axes: np.ndarray
    power: np.ndarray
    count: int

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S: exact, in longs, where they hold it, else in integers."""
        top = int(np.abs(y).max(initial=0)) * self.n + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if top < 1 << 62 else object
        return y.astype(np.int64).astype(kind) * self.n - np.array(self.sums, kind)

    def apply(self, y: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """(deviation, whitened) of scaled vectors."""
        away = self.centred(y)
        if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * max(1, away.shape[1]) < 2.0**62:
            deviation = (away * away).sum(1).tolist()
        else:
            deviation = [x if x < 1 << 63 else None for x in (away.astype(object) ** 2).sum(1).tolist()]
        return deviation, (away.astype(np.float64) @ self.axes.T) / np.sqrt(self.power)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening of (vec_id, embedding); see the module's text."""
    spark, width = vectors.sparkSession, width_of(vectors)
    n, sums, products = scatter(vectors, width)
    a = [[n * products[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace, count = sum(a[i][i] for i in range(width)), min(components, width)
    roots = real_roots(charpoly(spark, a)) if trace else []
    wanted, have = [], 0
    for k, r in enumerate(roots):
        if have < count:
            wanted.append((k, str(r.at), r.bits, r.times))
            have += r.times
    text = [[str(x) for x in row] for row in a]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        whole = [[int(x) for x in row] for row in text]
        for batch in batches:
            for k, at, bits, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                axes = null_space(whole, Root(int(at), bits, times)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([axes], pa.list_(pa.list_(pa.float64())))], names=["k", "axes"])

    axes: list[list[float]] = []
    if wanted:
        tasks = spark.createDataFrame(wanted, "k int, at string, bits int, times int").repartition(min(len(wanted), spark.sparkContext.defaultParallelism))
        found = {r.k: r.axes for r in tasks.mapInArrow(run, "k int, axes array<array<double>>").collect()}
        axes = [x for k in sorted(found) for x in found[k]][:count]
    power = [roots[k].value() for k, _, _, times in wanted for _ in range(times)][:count]
    return Whitening(n, sums, trace, np.array(axes).reshape(len(axes), width), np.array(power), count)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity; null without a component that has variance."""
    k, width = len(model.power), len(model.sums)
    if not k:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, w = model.apply(scaled(batch.column(0), width))
            sums, products = sums + w.sum(0), products + w.T @ w
        values = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["i", "v"])

    parts = vectors.select("embedding").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    values = np.array([r.v for r in parts.orderBy("i").collect()]) / model.n
    mean, second = values[:k], values[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    per row of (vec_id, embedding) and component."""
    clean = stored(finite_vectors(vectors).select("vec_id", "embedding"), "whitening-rows")
    model = fit(clean, components)
    error = identity_error(clean, model)
    width, k, count = len(model.sums), len(model.power), model.count
    share = [float(p) / model.trace for p in model.power] + [0.0 if model.trace else None] * (count - k)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if count else 0, SLICE):
                part = batch.slice(start, SLICE)
                deviation, w = model.apply(scaled(part.column(1), width))
                rows = part.num_rows
                full = np.concatenate([w, np.zeros((rows, count - k))], 1).ravel()
                absent = np.tile(np.arange(count) >= k, rows)
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(full, mask=absent),
                    pa.array(share * rows, pa.float64()),
                    pa.array([error] * (rows * count), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return clean.mapInArrow(run, schema)
