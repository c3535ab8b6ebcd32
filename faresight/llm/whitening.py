"""Whitening of embeddings from a covariance that is exact up to its last step.

Every entry c of a vector becomes the integer x = floor(SCALE * c) + OFFSET.
The scatter of these integers is found from bits: per dimension, x less the
dimension's least value is written in binary, each bit plane is packed across
rows into 64-bit words, and the product sum of two dimensions is the sum over
their plane pairs (i, j) of 2^(i+j) times the number of set bits of one plane
and the other. Tasks count bits for the rows they read and hand on, per pair of
dimensions, sums of a few 16-bit steps of the exponent, which Spark adds; so
what leaves a task, and what reaches the driver, depends on the dimension and
never on the rows. The driver centres the sums as integers of any length,
n * sum(x_a x_b) - sum(x_a) sum(x_b), divides once, and takes eigenvectors.

Vectors that are null, or hold null or non-finite entries, are dropped, and so
are those with an entry of ``BEYOND`` or more either way, whose x a double
would not hold exactly. Vectors of another length than most have (ties: the
shorter) share no covariance with the rest and are dropped too. Components
without variance, below ``FLAT`` of the largest, cannot be scaled to one and
are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import map_arrow, record, saved, table

#: Contract of the registered query.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32

#: Entries from here on do not count as finite: SCALE times them is 2^52.
BEYOND = 2.0 ** 46
#: Share of the largest eigenvalue below which a component has no variance.
FLAT = 1e-13
#: Exponents of two that one sum holds: counts of up to 2^40 rows times 2^15 and 54 plane pairs fit a long.
STEP = 16
#: Entries that a kernel works on at a time.
BLOCK = 1 << 20


def usable(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their lengths, their x in turn) of a list column; only lengths of ``dims`` if given."""
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten()
    c = np.asarray(values.cast(pa.float64()).fill_null(np.nan), np.float64)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(c) < BEYOND)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    good = np.asarray(column.is_valid()) & (np.bincount(owner[bad], minlength=len(sizes)) == 0) & (sizes > 0)
    if dims is not None:
        good &= sizes == dims
    x = np.floor(c[good[owner]] * SCALE).astype(np.int64) + OFFSET
    return np.flatnonzero(good), sizes[good], x


def _parts(batches: Iterator[pa.RecordBatch], name: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, usable rows, their x as a matrix) in runs of bounded size."""
    for batch in batches:
        step = max(1, BLOCK // max(1, dims))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            rows, _, x = usable(part.column(name), dims)
            if len(rows):
                yield part, rows, x.reshape(len(rows), dims)


def dimensions(vectors: DataFrame) -> tuple[int, np.ndarray, np.ndarray, int]:
    """(length, least x by dimension, greatest x, rows) of the vectors with the commonest length."""
    def kernel(batches):
        found: dict[int, list] = {}
        for batch in batches:
            _, sizes, x = usable(batch.column("v"))
            owner = np.repeat(sizes, sizes)
            for d in np.unique(sizes).tolist():
                part = x[owner == d].reshape(-1, d)
                low, high = part.min(0), part.max(0)
                held = found.get(d)
                if held:
                    low, high = np.minimum(low, held[1]), np.maximum(high, held[2])
                found[d] = [len(part) + (held[0] if held else 0), low, high]
        for d, (n, low, high) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([n], pa.int64()),
                 pa.array([low], pa.list_(pa.int64())), pa.array([high], pa.list_(pa.int64()))], ["dims", "n", "low", "high"])

    parts = saved(map_arrow(vectors.select("v"), kernel, "dims int, n long, low array<long>, high array<long>"), "bounds")
    most = parts.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dims").first()
    if most is None:
        return 0, np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    own = parts.where(F.col("dims") == most.dims).select(F.posexplode(F.arrays_zip("low", "high")).alias("d", "b"))
    bounds = own.groupBy("d").agg(F.min("b.low").alias("low"), F.max("b.high").alias("high")).orderBy("d").toArrow()
    return most.dims, bounds["low"].to_numpy(), bounds["high"].to_numpy(), most.n


def packed(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of a vector of integers below 2^bits, lowest first, as 64-bit words."""
    planes = (y[None, :] >> np.arange(bits)[:, None]) & 1
    padded = np.zeros((bits, -(-len(y) // 64) * 8), np.uint8)
    folded = np.packbits(planes.astype(np.uint8), axis=1)
    padded[:, :folded.shape[1]] = folded
    return padded.view(np.uint64)


class Scatter:
    """Sums over rows of y_a and of y_a * y_b, a <= b, in steps of the exponent.

    ``sums[s, a, b]`` times 2^(STEP * s), added over s, is the product sum;
    ``ones[s, a]`` likewise for the plain sums.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        most = int(bits.max(initial=0))
        steps = max(1, (2 * most - 2) // STEP + 1)
        self.sums = np.zeros((steps, len(bits), len(bits)), np.int64)
        self.ones = np.zeros((steps, len(bits)), np.int64)

    def add(self, y: np.ndarray) -> None:
        own = [packed(y[:, d], int(b)) for d, b in enumerate(self.bits)]
        places = np.concatenate([np.arange(b) for b in self.bits])
        planes = np.concatenate(own)
        begins = np.cumsum(self.bits) - self.bits
        wide = np.flatnonzero(self.bits)
        for a in wide:
            first = begins[a]
            later = wide[wide >= a]
            starts = begins[later] - first
            for i in range(self.bits[a]):
                counts = np.bitwise_count(own[a][i] & planes[first:]).sum(1, dtype=np.int64)
                exponent = i + places[first:]
                for s in range(len(self.sums)):
                    at = exponent // STEP == s
                    if at.any():
                        weighted = np.where(at, counts << (exponent % STEP), 0)
                        self.sums[s, a, later] += np.add.reduceat(weighted, starts)
                self.ones[i // STEP, a] += int(np.bitwise_count(own[a][i]).sum()) << (i % STEP)

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(a, b, s, sum) of what is not zero; b is -1 for the plain sums."""
        s, a, b = np.nonzero(self.sums)
        yield a, b, s, self.sums[s, a, b]
        s, a = np.nonzero(self.ones)
        yield a, np.full(len(a), -1), s, self.ones[s, a]


_SUMS = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("s", pa.int32()), ("total", pa.int64())])


def scatter(vectors: DataFrame, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, product sums) of x less ``low``, over all usable vectors, as Python integers."""
    dims = len(low)
    bits = np.array([int(h - l).bit_length() for l, h in zip(low.tolist(), high.tolist())], np.int64)

    def kernel(batches):
        held = Scatter(bits)
        for _, _, x in _parts(batches, "v", dims):
            held.add(x - low)
        for a, b, s, total in held.rows():
            yield record(_SUMS, a, b, s, total)

    sums = map_arrow(vectors.select("v"), kernel, "a int, b int, s int, total long")
    sums = sums.groupBy("a", "b", "s").agg(F.sum("total").alias("total")).toArrow()  # one row per pair of dimensions and step
    ones, products = np.zeros(dims, object), np.zeros((dims, dims), object)
    for a, b, s, total in zip(*(sums[n].to_pylist() for n in ("a", "b", "s", "total"))):
        if b < 0:
            ones[a] += total << (STEP * s)
        else:
            products[a, b] += total << (STEP * s)
            if a != b:
                products[b, a] = products[a, b]
    return ones, products


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: ``low`` and ``sums`` centre it, ``components`` (by falling
    eigenvalue, one a column) and ``scales`` project and scale it."""

    n: int
    low: np.ndarray
    sums: np.ndarray       # of x - low, as Python integers
    components: np.ndarray
    values: np.ndarray     # eigenvalues of the components
    trace: float

    def split_mean(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part, and remainder over n, of the mean of x - low."""
        return np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole part and fraction are taken apart, so that large sums cost no digits."""
        whole, rest = self.split_mean()
        return (x - self.low - whole).astype(np.float64) - rest / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2 of each row, exact; None beyond a long."""
        whole, rest = self.split_mean()
        y = x - self.low - whole
        fits = ((y * float(self.n) - rest) ** 2).sum(1) < 2.0 ** 62
        out: list[int | None] = [None] * len(x)
        exact = y[fits] * np.int64(self.n) - rest
        for at, value in zip(np.flatnonzero(fits), (exact * exact).sum(1).tolist()):
            out[at] = value
        for at in np.flatnonzero(~fits):
            value = sum((v * self.n - r) ** 2 for v, r in zip(y[at].tolist(), rest.tolist()))
            out[at] = value if value < 1 << 63 else None
        return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors(v)``, an array of doubles; None without usable rows."""
    dims, low, high, n = dimensions(vectors)
    if not n:
        return None
    sums, products = scatter(vectors, low, high)
    # integers until here: one division each, rounded once
    covariance = np.array([[(n * products[a, b] - sums[a] * sums[b]) / (n * n) for b in range(dims)] for a in range(dims)])
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    keep = values[:components] > max(0.0, FLAT * values[0])
    trace = sum(n * products[a, a] - sums[a] * sums[a] for a in range(dims)) / (n * n)
    return Whitening(n, low, sums, np.ascontiguousarray(vectors_[:, :components][:, keep]), values[:components][keep], trace)


_MOMENTS = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("total", pa.float64())])


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, from the rows themselves."""
    dims, k = len(model.low), len(model.values)
    if not k:
        return 0.0

    def kernel(batches):
        plain, products = np.zeros(k), np.zeros((k, k))
        for _, _, x in _parts(batches, "v", dims):
            w = model.apply(x)
            plain, products = plain + w.sum(0), products + w.T @ w
        a, b = np.triu_indices(k)
        yield record(_MOMENTS, np.r_[np.arange(k), a], np.r_[np.full(k, -1), b], np.r_[plain, products[a, b]])

    sums = map_arrow(vectors.select("v"), kernel, "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total"))
    mean, second = np.zeros(k), np.zeros((k, k))
    for r in sums.collect():  # k * (k + 3) / 2 rows
        if r.b < 0:
            mean[r.a] = r.total / model.n
        else:
            second[r.a, r.b] = second[r.b, r.a] = r.total / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


_WHITE = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``embeddings(vec_id, <vector>)`` projected on the leading components of their covariance.

    One row per usable vector and component (1 is the largest): vec_id,
    component, n (usable vectors), deviation (null beyond a long), whitened,
    explained, identity_error. Rows with equal or null vec_id are rows like any
    other. With no usable vector, or none that differs, the result is empty.
    Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    model = fit(rows, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], WHITE)
    error = identity_error(rows, model)
    dims, k = len(model.low), len(model.values)
    explained = model.values / model.trace

    def kernel(batches):
        for part, at, x in _parts(batches, "v", dims):
            ids = part.column("vec_id").take(pa.array(at))
            each = np.repeat(np.arange(len(at)), k)
            yield record(_WHITE, ids.take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)),
                         np.full(len(each), model.n), pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                         model.apply(x).ravel(), np.tile(explained, len(at)), np.full(len(each), error))

    return map_arrow(rows, kernel, WHITE)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable ``embeddings``, whitened: see ``whitened``."""
    return whitened(table(spark, sf_dir, "embeddings"))
