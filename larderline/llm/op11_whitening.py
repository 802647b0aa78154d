"""Embedding whitening; the leading eigenvectors of the covariance are found by spectrum slicing.

Each entry c becomes the integer floor(64 c) + 1,000,000. Sums and products of the distinct integer vectors are exact:
tasks add up products of entries from which the nearest integer to the mean has been taken, and the driver corrects
them by the remaining fraction. What reaches the driver is one matrix of the embedding's width, whatever the number of
rows.

Eigenvalues are counted, not guessed: the inertia of V - s (signs of the pivots in an LDL^T factorisation with symmetric
pivoting) says how many lie above s. Bisection on these counts isolates the k-th one; from the interval's middle,
inverse iteration and then Rayleigh quotient iteration (cubic) finish it; two more counts next to the result certify its
number. Each vector is kept orthogonal to those found before, so eigenvalues that agree to rounding get a basis.

Left out: rows whose vector is null, empty, or holds null or non-finite entries. Null and repeated ids keep their rows;
equal vectors count once in the fit and get equal values. Vectors of different lengths, or entries beyond 2^46 from
each other, are an error. A component without variance (eigenvalue 0 to rounding: fewer distinct vectors than
components, constant vectors) explains 0 and has no whitened value (null); the identity is checked for the others. An
empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm.common import arrow_map, column_of, stored, table
from larderline.llm.vectors import matrix

EPS = float(np.finfo(float).eps)


def pivots(shifted: np.ndarray) -> list[np.ndarray]:
    """The 1x1 and 2x2 blocks of D in an LDL^T factorisation with complete symmetric pivoting."""
    a = shifted.copy()
    blocks = []
    alpha = (1 + 17**0.5) / 8
    while (n := len(a)) > 0:
        size = np.abs(a)
        on = int(size.diagonal().argmax())
        if n == 1 or size[on, on] >= alpha * size.max():
            take = [on]
        else:
            take = sorted(divmod(int(size.argmax()), n))
        rest = np.delete(np.arange(n), take)
        d = a[np.ix_(take, take)]
        blocks.append(d)
        c = a[np.ix_(rest, take)]
        a = a[np.ix_(rest, rest)]
        if len(rest) and np.abs(d).max() > 0:
            a = a - c @ np.linalg.solve(d, c.T)
            a = (a + a.T) / 2
    return blocks


def above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``v`` greater than ``shift``: positive pivots of v - shift (a 2x2 pivot has one)."""
    found = 0
    for d in pivots(v - shift * np.eye(len(v))):
        found += 1 if len(d) == 2 else int(d[0, 0] > 0)
    return found


def orthogonal(x: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    """``x`` without its part along ``to``, of length one."""
    for _ in range(2):
        for y in to:
            x = x - (y @ x) * y
        x = x / np.linalg.norm(x)
    return x


def refine(v: np.ndarray, shift: float, start: np.ndarray, to: list[np.ndarray], scale: float) -> tuple[float, np.ndarray, float]:
    """Eigenvalue, unit vector and residual by inverse iteration at ``shift``, then Rayleigh quotient iteration.

    Every step stays orthogonal to ``to``. Ends when the residual is at rounding level or no longer falls.
    """
    eye, x = np.eye(len(v)), orthogonal(start, to)
    best, idle = (np.inf, shift, x), 0
    for step in range(60):
        at = shift if step < 4 else float(x @ v @ x)
        try:
            y = np.linalg.solve(v - at * eye, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (at + EPS * scale) * eye, x)
        if not np.isfinite(y).all() or not np.linalg.norm(y):
            break
        x = orthogonal(y / np.linalg.norm(y), to)
        value = float(x @ v @ x)
        off = float(np.linalg.norm(v @ x - value * x))
        idle = 0 if off < best[0] / 2 else idle + 1
        best = min(best, (off, value, x), key=lambda b: b[0])
        if step >= 4 and (off <= EPS * scale or idle > 3):
            break
    return best[1], best[2], best[0]


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    width = len(v)
    reach = float(np.abs(v).sum(1).max())
    if not reach:
        return np.zeros(min(k, width)), np.eye(width)[:k]
    counts: dict[float, int] = {}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(v, shift)
        return counts[shift]

    counts[-2 * reach], counts[2 * reach] = width, 0  # every eigenvalue lies within the largest row sum
    finest = 8 * width * EPS * reach
    random = np.random.default_rng(3)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for number in range(1, min(k, width) + 1):
        # count(low) >= number > count(high): the number-th eigenvalue lies in (low, high].
        low = max(s for s, n in counts.items() if n >= number)
        high = min(s for s, n in counts.items() if n < number)
        while True:
            while high - low > finest and (count(low) != number or count(high) != number - 1):
                middle = (low + high) / 2
                if count(middle) >= number:
                    low = middle
                else:
                    high = middle
            value, x, off = refine(v, (low + high) / 2, random.standard_normal(width), vectors, reach)
            if high - low <= finest:
                break
            if off <= finest and count(value - 2 * finest) >= number > count(value + 2 * finest):
                break
            # Not the wanted one yet: halve the interval and begin again.
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= number else (low, middle)
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors)


def integers(embeddings: DataFrame, name: Column) -> DataFrame:
    """vec_id and x (array<long>) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(name.alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    return rows.select("vec_id", F.transform("vector", lambda c: F.floor(c * 64) + F.lit(1_000_000).cast("long")).alias("x"))


def exact_products(rows: np.ndarray) -> list[list[int]]:
    """rows^T rows of integers, exactly: by floating point in pieces whose sums stay below 2^53."""
    width, most = rows.shape[1], int(np.abs(rows).max(initial=0))
    piece = min(len(rows), 2**53 // (most * most or 1))
    if piece < 1:
        many = rows.astype(object)
        return (many.T @ many).tolist()
    total = np.zeros((width, width), object)
    for at in range(0, len(rows), piece):
        part = rows[at : at + piece].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total.tolist()


class Fit:
    """What whitening needs, all of the embedding's width: n, the exact sums, centre, components and eigenvalues."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]], k: int) -> None:
        self.n, width = n, len(sums)
        self.centre = [round(Fraction(s, n)) for s in sums]
        #: Sums of x - centre.
        self.rest = [s - n * c for s, c in zip(sums, self.centre)]
        v = [[float(Fraction(n * products[i][j] - self.rest[i] * self.rest[j], n * n)) for j in range(width)] for i in range(width)]
        self.covariance = np.array(v).reshape(width, width)
        self.values, self.components = leading(self.covariance, k)
        trace = float(np.trace(self.covariance))
        solid = self.values > 8 * width * EPS * float(np.abs(self.covariance).sum(1).max(initial=0))
        self.solid = solid & (self.values > 0)
        self.explained = np.where(self.solid, self.values / trace, 0.0) if trace > 0 else np.zeros(len(self.values))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows on the components with variance, over the root of their eigenvalues."""
        centred = (x - np.array(self.centre, np.int64)).astype(np.float64) - np.array([float(Fraction(r, self.n)) for r in self.rest])
        return centred @ self.components[self.solid].T / np.sqrt(self.values[self.solid])

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2 of each row, exactly."""
        off = x - np.array(self.centre, np.int64)
        most = self.n * int(np.abs(off).max(initial=0)) + max(map(abs, self.rest), default=0)
        if most * most * x.shape[1] < 2**63:
            far = self.n * off - np.array(self.rest, np.int64)
            return (far * far).sum(1).tolist()
        far = self.n * off.astype(object) - np.array(self.rest, object)
        return (far * far).sum(1).tolist()


def sums_of(fit: DataFrame, shares: str, share) -> DataFrame:
    """Partial sums of each batch by place, added up exactly (decimals) or in floating point (doubles)."""
    parts = arrow_map(fit, f"i int, j int, value {shares}", share)
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def whiten(embeddings: DataFrame, k: int = 16) -> DataFrame:
    """vec_id, n, deviation (decimal(38,0)), whitened (array<double>, one entry a component), explained (array<double>)
    and identity_error of every row that takes part."""
    rows = integers(embeddings, F.col("vec_id"))
    fit = stored(rows.select("x").distinct())
    sizes = fit.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not sizes.n:
        return embeddings.sparkSession.createDataFrame([], schema)
    if sizes.least != sizes.most:
        raise ValueError(f"vectors of {sizes.least} to {sizes.most} entries: all must have the same length")
    n, width = sizes.n, sizes.most
    wide = "decimal(38,0)"

    def totals(batch):
        x = matrix(column_of(batch, "x")).astype(object)
        return {"i": list(range(width)), "j": [0] * width, "value": pa.array(x.sum(0).tolist(), pa.decimal128(38, 0))}

    # Collected here and below: at most width x width numbers.
    sums = [0] * width
    for r in sums_of(fit, wide, totals).collect():
        sums[r.i] = int(r.value)
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    i, j = (axis.tolist() for axis in np.triu_indices(width))

    def products(batch):
        off = matrix(column_of(batch, "x")) - centre
        if int(np.abs(off).max()) > 2**46:
            raise ValueError("entries lie further apart than whitening can count exactly")
        made = exact_products(off)
        return {"i": i, "j": j, "value": pa.array([made[a][b] for a, b in zip(i, j)], pa.decimal128(38, 0))}

    gram = [[0] * width for _ in range(width)]
    for r in sums_of(fit, wide, products).collect():
        gram[r.i][r.j] = gram[r.j][r.i] = int(r.value)
    made = Fit(n, sums, gram, k)
    spark = embeddings.sparkSession
    shared = spark.sparkContext.broadcast(made)  # of the embedding's width
    solid = int(made.solid.sum())

    def check(batch):
        white = np.hstack([shared.value.whitened(matrix(column_of(batch, "x"))), np.ones((batch.num_rows, 1))])
        total = white.T @ white
        return {"i": [a for a in range(solid + 1) for _ in range(solid + 1)], "j": [*range(solid + 1)] * (solid + 1), "value": total.ravel()}

    error = None
    if solid:
        total = np.zeros((solid + 1, solid + 1))
        for r in sums_of(fit, "double", check).collect():
            total[r.i, r.j] = r.value
        mean = total[:-1, -1] / n
        error = float(np.abs(total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(solid)).max())

    def placed(batch):
        x = matrix(column_of(batch, "x"))
        fit = shared.value
        places = len(fit.values)
        white, hidden = np.zeros((len(x), places)), np.tile(~fit.solid, len(x))
        white[:, fit.solid] = fit.whitened(x)
        far = [int(d) for d in fit.deviation(x)]
        starts = np.arange(0, len(hidden) + 1, places, dtype=np.int32)
        return {
            "vec_id": column_of(batch, "vec_id"),
            "n": [fit.n] * len(x),
            "deviation": pa.array(far, pa.decimal128(38, 0)),
            "whitened": pa.ListArray.from_arrays(starts, pa.array(white.ravel(), mask=hidden)).cast(pa.list_(pa.field("element", pa.float64()))),
            "explained": [fit.explained.tolist()] * len(x),
            "identity_error": [error] * len(x),
        }

    return arrow_map(rows, schema, placed)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component. A deviation that exceeds a long (beyond some 10^7 vectors) is null."""
    made = whiten(table(spark, sf_dir, "embeddings"))
    each = made.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        F.col("of.whitened").alias("whitened"),
        F.col("of.explained").alias("explained"),
        "identity_error",
    )
