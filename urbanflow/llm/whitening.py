"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries become integers, so the scatter of the distinct vectors (n squared times their covariance) is an
integer matrix and known exactly. Its characteristic polynomial is worked out modulo many primes (each by a
reduction to Hessenberg form; primes are dealt out over Spark tasks) and put together by Chinese remainders.
As all roots are real, the sign changes of the shifted polynomial count the roots beyond a point exactly: the
largest roots are isolated and narrowed to ``BITS`` binary places by bisection, repeated roots included, and
the rank is known without a threshold. Components are null vectors of the scatter less such a root, by inverse
iteration in fixed-point integers, one root (with its multiplicity) a Spark task.

Only the matrix (dimensions squared), never vectors, passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, landed_at, packed, ship, unpacked

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: binary places of a root, counted from its first one
BITS = 160
#: further places of the inverse iteration
GUARD = 128
#: rows that are multiplied at once, bits of a limb: sums of products stay exact in double precision
BLOCK, LIMB = 4096, 20
#: primes a row of the modular job
BATCH = 16
#: vectors whose 64-fold entries leave this range have no long and count as not finite
_RANGE = float(1 << 62)


# -- the polynomial ------------------------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller's test with bases that decide every n below 3 * 10^9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, largest first, until their product exceeds the bound."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def _power(base: np.ndarray, exponent: np.ndarray, p: np.ndarray) -> np.ndarray:
    out, base, exponent = np.ones_like(base), base % p, exponent.copy()
    while exponent.any():
        out = np.where(exponent & 1, out * base % p, out)
        base, exponent = base * base % p, exponent >> 1
    return out


def characteristic_mod(matrix: list[int], d: int, primes: list[int]) -> np.ndarray:
    """Coefficients modulo each prime of det(xI - matrix), highest power first: a similar matrix that is zero
    below the first subdiagonal, then the recurrence over its leading blocks."""
    p = np.array(primes, np.int64)
    h = np.array([[v % q for v in matrix] for q in primes], np.int64).reshape(len(primes), d, d)
    each, mod = np.arange(len(primes)), p[:, None, None]
    for k in range(1, d - 1):
        pivot = k + (h[:, k:, k - 1] != 0).argmax(axis=1)
        rows, own = h[each, pivot].copy(), h[each, k].copy()
        h[each, pivot], h[each, k] = own, rows
        columns, own = h[each, :, pivot].copy(), h[each, :, k].copy()
        h[each, :, pivot], h[each, :, k] = own, columns
        factor = h[:, k + 1:, k - 1] * _power(h[:, k, k - 1], p - 2, p)[:, None] % p[:, None]
        h[:, k + 1:] = (h[:, k + 1:] - factor[:, :, None] * h[:, k, None, :] % mod) % mod
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1:] * factor[:, None, :] % mod).sum(axis=2)) % p[:, None]
    polys = [np.zeros((len(primes), d + 1), np.int64)]  # lowest power first
    polys[0][:, 0] = 1
    for k in range(d):
        new = np.zeros_like(polys[0])
        new[:, 1:] = polys[k][:, :-1]
        new = (new - h[:, k, k, None] * polys[k] % p[:, None]) % p[:, None]
        product = np.ones(len(primes), np.int64)
        for i in range(k - 1, -1, -1):
            product = product * h[:, i + 1, i] % p
            new = (new - (h[:, i, k] * product % p)[:, None] * polys[i] % p[:, None]) % p[:, None]
        polys.append(new)
    return polys[-1][:, ::-1]


def remainders(primes: list[int], residues: np.ndarray) -> list[int]:
    """The integers between 0 and the product of the primes that have these residues (one row a prime)."""
    product = math.prod(primes)
    terms = [(product // p) * pow(product // p, -1, p) for p in primes]
    return [sum(int(r) * t for r, t in zip(column, terms)) % product for column in residues.T]


def polynomial(spark: SparkSession, matrix: list[int], d: int) -> list[int]:
    """Coefficients of det(xI - matrix), highest power first, of a symmetric matrix without negative eigenvalues.

    With such roots the k-th elementary symmetric function is at most C(d, k) (trace / d)^k."""
    trace = sum(matrix[i * d + i] for i in range(d))
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_beyond(bound)
    shared = spark.sparkContext.broadcast(matrix)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine in batch.column(0).to_pylist():
                found = characteristic_mod(shared.value, d, mine)
                yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                                                 ["prime", "residues"])

    parts = [(primes[i:i + BATCH],) for i in range(0, len(primes), BATCH)]
    rows = spark.createDataFrame(parts, "primes array<bigint>").repartition(len(parts)).mapInArrow(
        reduce, "prime long, residues array<bigint>").collect()
    shared.destroy()
    # (-1)^k times the k-th coefficient is not negative, and so is its own remainder
    sign = np.array([(-1) ** k for k in range(d + 1)])
    found = remainders([r["prime"] for r in rows], np.array([np.array(r["residues"]) * sign % r["prime"] for r in rows]))
    return [int(s) * e for s, e in zip(sign, found)]


# -- its roots -----------------------------------------------------------------------------------------


class RealRoots:
    """Roots of a monic integer polynomial that are all real and none negative, with their multiplicity."""

    def __init__(self, coefficients: list[int]):
        c = list(coefficients)
        while c[-1] == 0:  # roots that are zero
            c.pop()
        self.coefficients, self.rank = c, len(c) - 1

    def scaled(self, places: int) -> list[int]:
        """The polynomial whose roots are 2^places times as large, up to a factor."""
        d = self.rank
        if places >= 0:
            return [a << (k * places) for k, a in enumerate(self.coefficients)]
        return [a << ((d - k) * -places) for k, a in enumerate(self.coefficients)]

    @staticmethod
    def beyond(poly: list[int], at: int) -> int:
        """How many roots exceed ``at``: sign changes of the polynomial shifted by it (exact, all being real)."""
        c = list(poly)
        for i in range(len(c) - 1, 0, -1):
            carry = c[0]
            for j in range(1, i + 1):
                carry = c[j] = c[j] + at * carry
        signs = [x > 0 for x in c if x]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def largest(self, number: int) -> list[tuple[int, int, int]]:
        """(numerator, places, multiplicity) of the distinct largest roots, down to the given number of roots:
        each lies in (numerator, numerator + 1] / 2^places and is known to BITS places from its first one."""
        out, taken = [], 0
        top = self.coefficients[1].bit_length() if self.rank else 0  # the sum of the roots
        while taken < min(number, self.rank):
            low, high = -1, top  # 2^low < root <= 2^high
            while self.beyond(self.scaled(-low), 1) <= taken:
                low, high = 2 * low, low
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if self.beyond(self.scaled(-mid), 1) > taken else (low, mid)
            top, places = high, BITS - high
            poly = self.scaled(places)
            a, b = 1 << (BITS - 1), 1 << BITS
            alone = False
            while b - a > 1 and not alone:
                mid = (a + b) // 2
                found = self.beyond(poly, mid)
                a, b = (mid, b) if found > taken else (a, mid)
                alone = self.beyond(poly, a) - taken == 1 and self.beyond(poly, b) == taken
            sign = None
            while b - a > 1:  # one simple root is left: the sign of the polynomial tells its side
                mid, value = (a + b) // 2, 0
                for c in poly:
                    value = value * mid + c
                sign = taken % 2 == 0 if sign is None else sign  # the sign beyond the root
                a, b = (a, mid) if value == 0 or (value > 0) == sign else (mid, b)
            many = self.beyond(poly, a) - taken
            out.append((a, places, many))
            taken += many
        return out


# -- components ----------------------------------------------------------------------------------------


def null_vectors(matrix: list[int], d: int, root: int, places: int, many: int) -> list[list[float]]:
    """Unit vectors that span the null space of matrix less (root + 1/2) / 2^places: inverse iteration from
    ``many`` fixed vectors, in integers with GUARD places beyond the root's."""
    bits = max(places, 0) + GUARD
    one = 1 << bits
    shift = ((2 * root + 1) << bits) >> (places + 1) if places >= -1 else ((2 * root + 1) << bits) << (-places - 1)
    a = np.array([v << bits for v in matrix], object).reshape(d, d)
    for i in range(d):
        a[i, i] -= shift
    order, lower = list(range(d)), np.zeros((d, d), object)
    for k in range(d):  # rows change places so that the pivot is the largest
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        if best != k:
            a[[k, best]], lower[[k, best]] = a[[best, k]], lower[[best, k]]
            order[k], order[best] = order[best], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        for i in range(k + 1, d):
            if a[i, k]:
                f = (a[i, k] << bits) // a[k, k]
                lower[i, k] = f
                a[i, k:] -= (f * a[k, k:]) >> bits
    def unit(v):
        return (v << bits) // max(math.isqrt(int((v * v).sum())), 1)

    found: list[np.ndarray] = []
    for m in range(many):
        v = unit(np.array([((i * 7919 + m * 104729 + 12345) * 48271 % 2147483647 - (1 << 30)) << GUARD for i in range(d)], object))
        for _ in range(2):
            x = v[order]
            for i in range(1, d):
                x[i] -= int((lower[i, :i] * x[:i]).sum()) >> bits
            for i in range(d - 1, -1, -1):
                x[i] = ((int(x[i]) << bits) - int((a[i, i + 1:] * x[i + 1:]).sum())) // a[i, i]
            v = unit(x)
            for other in found:  # components of one repeated root
                v = v - ((int((v * other).sum()) >> bits) * other >> bits)
            v = unit(v)
        found.append(v)
    out = []
    for v in found:
        w = [int(x) / one for x in v]
        flip = -1.0 if w[max(range(d), key=lambda i: abs(w[i]))] < 0 else 1.0
        out.append([flip * x for x in w])
    return out


def components(spark: SparkSession, matrix: list[int], d: int, roots: list[tuple[int, int, int]]) -> list[list[list[float]]]:
    """Null vectors of each root, one task a root."""
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = null_vectors(shared.value, d, int(r["root"]), r["places"], r["many"])
                yield pa.RecordBatch.from_arrays([pa.array([r["k"]], pa.int32()), pa.array([found], pa.list_(pa.list_(pa.float64())))],
                                                 ["k", "vectors"])

    asked = [(k, str(a), places, many) for k, (a, places, many) in enumerate(roots)]
    rows = (spark.createDataFrame(asked, "k int, root string, places int, many int").repartition(max(len(asked), 1), "k")
            .mapInArrow(solve, "k int, vectors array<array<double>>").collect())
    shared.destroy()
    return [r["vectors"] for r in sorted(rows, key=lambda r: r["k"])]


# -- rows ----------------------------------------------------------------------------------------------


def integers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long") + OFFSET)


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, not finite or beyond a long."""
    def bad(c):
        return c.isNull() | F.isnan(c) | (F.abs(c * SCALE) >= _RANGE)

    return vector.isNotNull() & ~F.exists(vector.cast("array<double>"), bad)


def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """z as sum of limb k times 2^(LIMB k), all but the last from 0 on, as doubles."""
    out = []
    while len(z) and (z.min() < -(1 << LIMB) or z.max() > 1 << LIMB):
        out.append((z & ((1 << LIMB) - 1)).astype(float))
        z = z >> LIMB
    return [*out, z.astype(float)]


def _scatter(centre: list[int], d: int):
    upper = np.triu_indices(d)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        blocks = 0

        def out():
            for limb, s in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([limb], pa.int32()), pa.array([s[upper].tolist()], pa.list_(pa.int64()))],
                                                 ["limb", "cells"])
            sums.clear()

        for x in _arrays(batches, d):
            for at in range(0, len(x), BLOCK):
                limbs = _limbs(x[at:at + BLOCK] - np.array(centre, np.int64))
                for i, a in enumerate(limbs):
                    for j, b in enumerate(limbs):
                        s = (a.T @ b).astype(np.int64)
                        sums[i + j] = sums.get(i + j, 0) + s
                blocks += 1
                if blocks % 64 == 0:  # sums of 4 limb pairs x 64 blocks of less than 2^53 each
                    yield from out()
        yield from out()
    return scatter


def _arrays(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Whitening:
    """What a fit knows: n distinct vectors with sums S; components as rows, by falling variance."""

    n: int
    sums: list[int]
    vectors: list[list[float]]
    variances: list[float]
    explained: list[float]
    identity_error: float | None = None

    def frame(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(integer centre, distance of the mean from it, projection onto whitened components)."""
        centre = [round(Fraction(s, self.n)) for s in self.sums]
        off = [float(Fraction(s, self.n) - c) for s, c in zip(self.sums, centre)]
        scale = np.sqrt(np.array(self.variances, float))
        return (np.array(centre, np.int64), np.array(off), (np.array(self.vectors, float).reshape(-1, len(self.sums)) / scale[:, None]).T)


def _project(model: Whitening):
    centre, off, onto = model.frame()
    return lambda x: ((x - centre).astype(float) - off) @ onto


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums of (n x - S)^2."""
    if not len(x):
        return []
    d = len(sums)
    most = max(n * max(abs(int(x[:, i].max())), abs(int(x[:, i].min()))) + abs(s) for i, s in enumerate(sums))
    if most < 1 << 62:
        y = x * np.int64(n) - np.array(sums, np.int64)
        if int(np.abs(y).max()) ** 2 * d < 1 << 63:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
    else:
        y = x.astype(object) * n - np.array(sums, object)
    return (y * y).sum(axis=1).tolist()


def _transform(model: Whitening):
    project, sums, n = _project(model), model.sums, model.n
    limit = 10 ** 38

    def transform(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums))
            exact = [Decimal(v) if v < limit else None for v in deviations(x, n, sums)]
            w = project(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.StructArray.from_arrays([pa.array(exact, pa.decimal128(38, 0)), lists], ["deviation", "whitened"])
    return F.arrow_udf(transform, "deviation decimal(38,0), whitened array<double>")


def _moments(model: Whitening, mean: list[float]):
    project, mean = _project(model), np.array(mean)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        sums = np.zeros((k, k + 1))
        for x in _arrays(batches, len(model.sums)):
            w = project(x) - mean
            sums += np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], ["cells"])
    return moments


def _summed(df: DataFrame, *keys: str) -> dict:
    """Sums over the rows of an array's cells, by position and keys."""
    rows = df.select(*keys, F.posexplode("cells").alias("at", "v")).groupBy(*keys, "at").agg(F.sum("v").alias("v")).collect()
    return {tuple(r[:-1]): r["v"] for r in rows}


def fit(vectors: DataFrame, x_col: str, number: int = COMPONENTS) -> Whitening | None:
    """Whitening of integer vectors (arrays of longs, all of one length), each distinct one once. None: no vector."""
    spark = vectors.sparkSession
    ship(spark)
    rows, path = landed_at(vectors.select(F.col(x_col).alias("x")).distinct(), "whitening_fit")
    sums = {r["at"]: (int(r["s"]), r["n"]) for r in rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()}
    if not sums:
        discard(spark, path)
        return None
    d, n = len(sums), sums[0][1]
    s = [sums[i][0] for i in range(d)]
    centre = [round(Fraction(v, n)) for v in s]
    cells = _summed(rows.mapInArrow(_scatter(centre, d), "limb int, cells array<bigint>").withColumn(
        "cells", F.col("cells").cast("array<decimal(38,0)>")), "limb")
    rest = [v - n * c for v, c in zip(s, centre)]
    matrix = [0] * (d * d)
    for at, (i, j) in enumerate(zip(*(x.tolist() for x in np.triu_indices(d)))):
        value = sum(int(v) << (LIMB * limb) for limb, v in ((limb, cells.get((limb, at))) for limb in range(8)) if v is not None)
        matrix[i * d + j] = matrix[j * d + i] = n * value - rest[i] * rest[j]
    common = math.gcd(*matrix) or 1
    matrix = [v // common for v in matrix]
    trace = sum(matrix[i * d + i] for i in range(d))
    model = Whitening(n, s, [], [], [])
    if trace:
        roots = RealRoots(polynomial(spark, matrix, d)).largest(number)
        for (a, places, _), found in zip(roots, components(spark, matrix, d, roots)):
            root = Fraction(2 * a + 1, 2) / Fraction(2) ** places
            for v in found:
                model.vectors.append(v)
                model.variances.append(float(root * common / n ** 2))
                model.explained.append(float(root / trace))
        for part in (model.vectors, model.variances, model.explained):
            del part[number:]
        zero = [0.0] * len(model.variances)
        k = len(zero)
        total = _summed(rows.mapInArrow(_moments(model, zero), "cells array<double>"))
        mean = [total[i * (k + 1) + k,] / n for i in range(k)]
        total = _summed(rows.mapInArrow(_moments(model, mean), "cells array<double>"))
        model.identity_error = max(abs(total[i * (k + 1) + j,] / n - (i == j)) for i in range(k) for j in range(k))
    discard(spark, path)
    return model


RESULTS = ["n", "deviation", "whitened", "explained", "identity_error"]


def whiten(rows: DataFrame, vector_col: str = "embedding", carry: list[str] | None = None, number: int = COMPONENTS) -> DataFrame:
    """Each row with a usable vector, with n, deviation (decimal(38,0), null beyond), whitened and explained (one
    entry per component, by falling variance) and identity_error.

    Rows go whose vector is null, holds a null, not finite or (64-fold) no long entry, or has another length than
    most usable vectors (ties: the longest). Components are at most ``number`` and at most the rank of the
    scatter: directions without variance have no whitened value. So a single distinct vector gives empty arrays
    and a null identity_error, as do vectors without entries. Repeated rows: each is returned, the fit takes them
    once; a root that repeats gives that many components, orthogonal to each other. Empty table: no rows.
    Columns as ``unpacked`` says.
    """
    spark = rows.sparkSession
    ship(spark)
    good = rows.select(packed(rows, carry), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    good = good.select("__in", integers(F.col("v")).alias("x"))
    size = good.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    model = None
    if size is not None:
        good = good.where(F.size("x") == size["size"])
        model = fit(good, "x", number)
    none = F.array().cast("array<double>")
    if model is None:
        out = {"n": F.lit(0 if size is None else 1).cast("long"), "deviation": F.lit(0).cast("decimal(38,0)"), "whitened": none,
               "explained": none, "identity_error": F.lit(None).cast("double")}
        return unpacked(good.select("__in", *[c.alias(k) for k, c in out.items()]), RESULTS)
    found = good.select("__in", _transform(model)(F.col("x")).alias("w"))
    return unpacked(found.select(
        "__in", F.lit(model.n).cast("long").alias("n"), F.col("w.deviation").alias("deviation"), F.col("w.whitened").alias("whitened"),
        (F.array(*[F.lit(e) for e in model.explained]) if model.explained else none).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error")), RESULTS)
