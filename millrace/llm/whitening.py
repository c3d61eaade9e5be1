"""Whitening of vectors by the exact characteristic polynomial of their scatter.

Components are whole numbers. Spark adds up, over all different vectors, first their sums, then the
products of what is left after the nearest whole mean is taken away: centred before anything is multiplied, and exact.
With n vectors, sums s and products Q of these, n * Q - s s' is n * n times the covariance, in whole numbers.

Its characteristic polynomial is computed modulo primes below 2**31, a Spark row for each, by reduction
to Hessenberg form, and put together by Chinese remainders; a bound on the coefficients tells how many
primes are needed. All roots are real, so sign changes of the moved polynomial count the roots above any
point exactly; that isolates the largest ones, after repeated ones have been split off. Each root is then refined to
320 bits, and its vectors are found by inverse iteration with 448 bits, a Spark row for each root. See
``charpoly``.

What the driver holds are sums, products and polynomial: by the square of the number of dimensions, whatever the
number of rows. Rows are read three times and never shuffled but to find the different ones.

Defined cases: null vectors, those with a null or non-finite entry, those with an entry whose whole number does not fit in 2**53,
and rows without an id take no part, nor do vectors of another length than the most frequent
(of equally frequent ones the longest). Repeated rows count once in the fit and are returned each. A
component needs a positive eigenvalue, so there are as many as the rank, 16 at most: none for one vector
alone, for equal vectors, or for an empty table. A repeated eigenvalue has as many components. The largest entry of a
component's vector is positive. A deviation that does not fit a long is null.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from math import gcd, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from . import charpoly
from .textkit import rested, ship

TOP = 16
#: Vectors that are multiplied together.
BLOCK = 2048
WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def whole(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(batches):
    """How many vectors a task has (``i`` -1), and the sum of each dimension."""
    n, total = 0, None
    for batch in batches:
        x = whole(batch.column("x"))
        if len(x):
            n += len(x)
            own = x.astype(object).sum(axis=0) if np.abs(x).max() * len(x) >= 2**62 else x.sum(axis=0)
            total = own.astype(object) if total is None else total + own
    if n:
        yield pa.record_batch(
            [pa.array(np.arange(-1, len(total)), pa.int32()), decimals([n, *total])], names=["i", "s"]
        )


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers: in double precision where no sum can reach 2**53."""
    size = float(np.abs(y.astype(float)).max(initial=0))
    if size * size * BLOCK >= 2**53:
        y = y.astype(object)
        return y.T.dot(y)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), BLOCK):
        part = y[at : at + BLOCK].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def products(centre: np.ndarray):
    """Sums (``j`` -1) and products of a task's vectors less ``centre``."""

    def run(batches):
        total = first = None
        for batch in batches:
            x = whole(batch.column("x"))
            if len(x):
                y = x - centre
                own, more = exact_products(y), y.astype(object).sum(axis=0)
                total = own if total is None else total + own
                first = more if first is None else first + more
        if total is not None:
            d = len(centre)
            i, j = np.triu_indices(d)
            yield pa.record_batch(
                [
                    pa.array(np.r_[np.arange(d), i], pa.int32()),
                    pa.array(np.r_[np.full(d, -1), j], pa.int32()),
                    decimals([*first, *total[i, j]]),
                ],
                names=["i", "j", "s"],
            )

    return run


def polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Characteristic polynomial of a whole-number matrix without negative eigenvalues."""
    trace = int(sum(matrix[i, i] for i in range(len(matrix))))
    moduli = charpoly.primes(charpoly.coefficient_bits(len(matrix), trace) + 1)

    def run(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                found = charpoly.characteristic(matrix, p)
                yield pa.record_batch(
                    [pa.array([p]), pa.array([found], pa.list_(pa.int64()))], names=["p", "residues"]
                )

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    found = rows.mapInArrow(rested(run), "p long, residues array<long>").collect()
    return charpoly.combined([(r.p, r.residues) for r in found])


def eigen(spark, matrix: np.ndarray, top: int) -> list[tuple[int, list[float]]]:
    """The ``top`` largest positive eigenvalues, times 2**ROOT_BITS, each with its vector."""
    roots = charpoly.largest_roots(polynomial(spark, matrix), top)
    if not roots:
        return []

    def refine(batches):
        for batch in batches:
            for k in batch.column("k").to_pylist():
                factor, place, times = roots[k]
                root = charpoly.refined(factor, *place)
                vectors = charpoly.null_vectors(matrix, root, times)
                yield pa.record_batch(
                    [
                        pa.array([str(root)] * times),
                        pa.array(range(times), pa.int32()),
                        pa.array(vectors, pa.list_(pa.float64())),
                    ],
                    names=["root", "turn", "vector"],
                )

    rows = spark.createDataFrame([(k,) for k in range(len(roots))], "k int").repartition(len(roots))
    found = rows.mapInArrow(rested(refine), "root string, turn int, vector array<double>").collect()
    found = sorted(found, key=lambda r: (-int(r.root), r.turn))
    return [(int(r.root), r.vector) for r in found[:top]]


class Whitener:
    """The fit: centre, sums, eigenvalues and vectors."""

    def __init__(self, n: int, centre: np.ndarray, first, values: list[float], vectors, explained):
        self.n, self.centre = n, centre
        self.first = np.array([int(s) for s in first], object)
        self.values, self.explained = np.array(values), np.array(explained)
        self.directions = np.array(vectors, np.float64).reshape(len(values), len(centre))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x less the sums, exact."""
        y = x - self.centre
        largest = float(np.abs(y.astype(float)).max(initial=0)) * self.n
        if largest + max(map(abs, self.first), default=0) < 2**53:
            return y * self.n - self.first.astype(np.int64)
        return y.astype(object) * self.n - self.first

    def white(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.directions.T / np.sqrt(self.values)


def covariances(fit: Whitener):
    """Sums (``j`` -1) and products of a task's whitened vectors."""

    def run(batches):
        k = len(fit.values)
        first, total = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = whole(batch.column("x"))
            if len(x):
                w = fit.white(fit.deviations(x))
                first += w.sum(axis=0)
                total += w.T @ w
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.record_batch(
            [
                pa.array(np.r_[np.arange(k), i], pa.int32()),
                pa.array(np.r_[np.full(k, -1), j], pa.int32()),
                pa.array(np.r_[first, total.ravel()]),
            ],
            names=["i", "j", "s"],
        )

    return run


def project(fit: Whitener):
    def run(batches):
        k = len(fit.values)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                deviations = fit.deviations(whole(part.column("x")))
                squares = (deviations.astype(object) ** 2).sum(axis=1)
                squares = [int(s) if s < 2**63 else None for s in squares]
                n = part.num_rows
                yield pa.record_batch(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                        pa.array(np.full(n * k, fit.n), pa.int64()),
                        pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(fit.white(deviations).ravel()),
                        pa.array(np.tile(fit.explained, n)),
                    ],
                    names=[c.split()[0] for c in WHITE.split(", ")],
                )

    return run


def learn(fit_list: DataFrame, top: int = TOP) -> Whitener | None:
    """The fit over the vectors ``x`` of ``fit_list``, or None where there is no component."""
    spark = fit_list.sparkSession
    found = fit_list.mapInArrow(rested(sums), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s"))
    found = {i: int(s) for i, s in found.collect()}
    if not found:
        return None
    n, d = found[-1], len(found) - 1
    # The nearest whole mean; what it leaves is taken away below.
    centre = np.array([(2 * found[i] + n) // (2 * n) for i in range(d)], np.int64)
    made = fit_list.mapInArrow(rested(products(centre)), "i int, j int, s decimal(38,0)")
    made = made.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    first, scatter = [0] * d, np.zeros((d, d), object)
    for i, j, s in made:
        if j < 0:
            first[i] = int(s)
    for i, j, s in made:
        if j >= 0:
            scatter[i, j] = scatter[j, i] = n * int(s) - first[i] * first[j]
    divisor = gcd(*[int(v) for v in scatter.ravel()])
    if not divisor:
        return None
    scatter //= divisor
    pairs = eigen(spark, scatter, top)
    trace = int(sum(scatter[i, i] for i in range(d)))
    one = 1 << charpoly.ROOT_BITS
    return Whitener(
        n,
        centre,
        first,
        [float(Fraction(root * divisor, one * n * n)) for root, _ in pairs],
        [v for _, v in pairs],
        [float(Fraction(root, one * trace)) for root, _ in pairs],
    )


def whitened(vectors: DataFrame, top: int = TOP) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``vectors`` has ``vec_id`` and ``x``, an array of longs.
    """
    spark = vectors.sparkSession
    ship(spark)
    sizes = vectors.filter("size(x) > 0").groupBy(F.size("x").alias("d")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    rows = vectors.select("vec_id", "x").filter(F.size("x") == (usual.d if usual else 0))
    rows = durable(rows, "white-rows")
    fit_list = durable(rows.select("x").distinct(), "white-fit")
    fit = learn(fit_list, top) if usual else None
    if fit is None:
        return rows.limit(0).select(
            "vec_id",
            *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in WHITE.split(", ")[1:]],
            F.lit(None).cast("double").alias("identity_error"),
        )
    k = len(fit.values)
    found = fit_list.mapInArrow(rested(covariances(fit)), "i int, j int, s double")
    found = {(i, j): s for i, j, s in found.groupBy("i", "j").agg(F.sum("s")).collect()}
    error = max(
        abs(found[i, j] / fit.n - found[i, -1] * found[j, -1] / fit.n**2 - (i == j))
        for i in range(k)
        for j in range(k)
    )
    return rows.mapInArrow(rested(project(fit)), WHITE).withColumn("identity_error", F.lit(error))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    fits = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(64 * x.cast("double")) < F.lit(2.0**53)),
    )
    x = F.transform("embedding", lambda c: F.floor(64 * c.cast("double")) + F.lit(1_000_000))
    rows = table.dropna(subset=["vec_id", "embedding"]).filter(fits)
    return whitened(rows.select("vec_id", x.cast("array<long>").alias("x")))
