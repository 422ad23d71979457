"""Embedding whitening with a covariance from variances only (polarisation).

Entries become whole numbers, ``x = floor(64 c) + 1000000``, and each different vector counts once. Of these, tasks
add up exact squares of centred values for every dimension and for the sum of every two dimensions; as
cov(i, j) = (var(i + j) - var(i) - var(j)) / 2, that gives the whole covariance matrix, whose eigenvectors whiten.

Centring comes before squaring: with m the mean rounded down and r = S - n m, sums of z = x - m and of its squares are whole
numbers, and n sum(z^2) - r^2 is n times the sum of squares around the true mean, exactly. Squares of large
values are added by limbs of 20 bits, so nothing overflows. Only sums by dimension and pair of
dimensions come to the driver, whatever the number of rows; the different vectors are found by a shuffle of
their packed numbers (a byte an entry where numbers are small) that tasks have made distinct before, and are
written, so a vector that a third of all rows hold moves once per task.

Nulls and edge cases: a row whose vector is null or holds a null or non-finite entry is dropped, and so is one of
another length than most rows have (of lengths as frequent, the greater counts) or of length 0. Entries beyond 2**62 count as
that. Repeated rows are whitened each. A null ``vec_id`` is passed through. Dimensions that do not vary on their own give no
component: there are as many as the covariance has eigenvalues above rounding, so with a single vector none. Where the
sum of ``deviation`` does not fit a long it is null. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.exchange import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 62)
LIMB = 20
# Rows that are multiplied together: sums of so many products of two limbs fit a long.
ROWS = 4096

PACKED = "vec_id bigint, size int, packed binary"
SUMS = "i int, j int, power int, total bigint"
WHITENED = "vec_id bigint, deviation bigint, whitened array<double>"
PRODUCTS = "i int, j int, product double"


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row's numbers less ``SHIFT`` in the fewest bytes that hold them; equal rows give equal bytes."""
    y = x - SHIFT
    width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], np.maximum(y.max(1, initial=0) + 1, -y.min(1, initial=0)))
    return [bytes([w]) + row.astype(f"<i{1 << w}").tobytes() for w, row in zip(width.tolist(), y, strict=True)]


def _unpack(packed: pa.Array, dimensions: int) -> np.ndarray:
    out = np.empty((len(packed), dimensions), np.int64)
    raw = packed.to_pylist()
    for w in {x[0] for x in raw}:
        at = [k for k, x in enumerate(raw) if x[0] == w]
        out[at] = np.frombuffer(b"".join(raw[k][1:] for k in at), f"<i{1 << w}").reshape(len(at), dimensions)
    return out + SHIFT


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch["embedding"]
        whole = pc.fill_null(pc.greater(pc.list_value_length(vectors), 0), False)
        batch = batch.filter(whole)
        vectors = batch["embedding"]
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        values = pc.fill_null(vectors.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(sizes)])
        good = np.add.reduceat(~np.isfinite(values), first[:-1]) == 0 if len(sizes) else np.zeros(0, bool)
        packed: list[bytes | None] = [None] * len(sizes)
        for size in np.unique(sizes[good]):
            at = np.flatnonzero(good & (sizes == size))
            x = np.floor(np.clip(SCALE * values[first[at][:, None] + np.arange(size)], -LARGEST, LARGEST)).astype(np.int64) + SHIFT
            for k, row in zip(at, _pack(x), strict=True):
                packed[k] = row
        columns = [batch["vec_id"], pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "packed"]).filter(pa.array(good))


def quantised(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, size, packed)`` of the rows that have a whole vector."""
    return embeddings.selectExpr("cast(vec_id as bigint) as vec_id", "cast(embedding as array<double>) as embedding").mapInArrow(_quantised, PACKED)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as a sum of limbs times powers of ``2 ** LIMB``; all but the last are from 0 up."""
    found = []
    while y.size and max(int(y.max()), -int(y.min())) >= 1 << LIMB:
        found.append(y & ((1 << LIMB) - 1))
        y = y >> LIMB
    return [*found, y]


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, len(batch), ROWS):
            part = batch.slice(begin, ROWS)
            yield part, _unpack(part["packed"], dimensions)


def _rows_of(totals: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    """``totals[offset, power]``, an array by dimension i of sums for the dimensions i and i + offset, as rows."""
    parts = [(np.arange(len(t)), np.arange(len(t)) + offset, np.full(len(t), power), t) for (offset, power), t in totals.items()]
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (list(zip(*parts, strict=True)) or [()] * 4)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["i", "j", "power", "total"])


class _Totals:
    """Sums by offset and power of the limb, given out as rows before they could overflow."""

    def __init__(self) -> None:
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.blocks = 0

    def add(self, offset: int, power: int, sums: np.ndarray) -> None:
        self.sums[offset, power] = self.sums.get((offset, power), 0) + sums

    def block_done(self) -> pa.RecordBatch | None:
        self.blocks += 1
        # A block's sum is below 2 * 4096 * 2**40 = 2**53.
        if self.blocks < 512:
            return None
        return self.rest()

    def rest(self) -> pa.RecordBatch:
        out, self.sums, self.blocks = _rows_of(self.sums), {}, 0
        return out


def _summer(dimensions: int):
    """Sums of every dimension, by limbs; the sum of ones is the number of vectors."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals()
        for _, x in _blocks(batches, dimensions):
            for power, limb in enumerate(_limbs(x)):
                totals.add(0, power, limb.sum(0))
            totals.add(dimensions, 0, np.array([len(x)]))
            if (full := totals.block_done()) is not None:
                yield full
        yield totals.rest()

    return add_up


def _squarer(means: np.ndarray):
    """Sums of squares of centred values: of every dimension (i, i) and of the sum of every two (i, j)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals()
        for _, x in _blocks(batches, len(means)):
            z = x - means
            for offset in range(len(means)):
                limbs = _limbs(z[:, offset:] + z[:, : len(means) - offset] if offset else z)
                for a, one in enumerate(limbs):
                    totals.add(offset, 2 * a, np.einsum("ij,ij->j", one, one))
                    for b in range(a):
                        totals.add(offset, a + b, 2 * np.einsum("ij,ij->j", one, limbs[b]))
            if (full := totals.block_done()) is not None:
                yield full
        yield totals.rest()

    return add_up


def _added(sums: DataFrame) -> dict[tuple[int, int], int]:
    """The total of each pair of dimensions as one whole number."""
    out: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("i", "j", "power").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r.i, r.j] = out.get((r.i, r.j), 0) + (int(r.total) << (LIMB * r.power))
    return out


@dataclass
class Whitening:
    """What is fitted: number and sums of the vectors, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray  # a column for each component
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.means) - np.array([r / self.n for r in self.rests])
        return centred @ (self.vectors / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S) ** 2)`` of each row, from whole numbers of any size."""
        z = x - self.means
        squares = sum((np.einsum("ij,ij->i", a, b).astype(object) << (LIMB * (p + q))) for p, a in enumerate(_limbs(z)) for q, b in enumerate(_limbs(z)))
        with_rest = 0
        limbs = [np.array([r >> (LIMB * q) & ((1 << LIMB) - 1) for r in self.rests], np.int64) for q in range(-(-self.n.bit_length() // LIMB))]
        for p, a in enumerate(_limbs(z)):
            for q, b in enumerate(limbs):
                with_rest = with_rest + ((a @ b).astype(object) << (LIMB * (p + q)))
        of_rest = sum(r * r for r in self.rests)
        found = self.n * self.n * squares - 2 * self.n * with_rest + of_rest
        return [d if d < 1 << 63 else None for d in found]


def covariance(squares: dict[tuple[int, int], int], n: int, rests: list[int]) -> np.ndarray:
    """From the sums of squares of centred values, by polarisation; each entry is one exact fraction."""
    out = np.empty((len(rests), len(rests)))
    around = {(i, j): n * total - (rests[i] if i == j else rests[i] + rests[j]) ** 2 for (i, j), total in squares.items()}
    for (i, j), both in around.items():
        out[i, j] = out[j, i] = both / n**2 if i == j else (both - around[i, i] - around[j, j]) / (2 * n**2)
    return out


def fit(vectors: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different ``vectors (packed)``; None if there are none."""
    sums = _added(vectors.select("packed").mapInArrow(_summer(dimensions), SUMS))
    n = sums.get((0, dimensions), 0)
    if not n:
        return None
    fitted = Whitening(n, [sums[i, i] for i in range(dimensions)], np.zeros(0), np.zeros((dimensions, 0)), 0.0)
    squares = _added(vectors.select("packed").mapInArrow(_squarer(fitted.means), SUMS))
    matrix = covariance(squares, n, fitted.rests)
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(dimensions, 1) * np.finfo(float).eps * max(float(values.max()), 0.0)]
    axes = axes[:, order]
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(len(order))])
    fitted.eigenvalues, fitted.vectors, fitted.trace = values[order], axes, float(np.trace(matrix))
    return fitted


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on the ``vectors (packed)``."""
    k = len(fitted.eigenvalues)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for _, x in _blocks(batches, len(fitted.sums)):
            y = fitted.whitened(x)
            total += np.hstack([y.T @ y, y.sum(0)[:, None]])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "product"])

    if not k:
        return 0.0
    total = np.zeros((k, k + 1))
    for r in vectors.select("packed").mapInArrow(multiply, PRODUCTS).groupBy("i", "j").agg(F.sum("product").alias("product")).collect():
        total[r.i, r.j] = r.product
    mean = total[:, k] / fitted.n
    return float(np.abs(total[:, :k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)`` per row of ``vectors (vec_id, packed)``."""

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _blocks(batches, len(fitted.sums)):
            y = fitted.whitened(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([rows["vec_id"], pa.array(fitted.deviations(x), pa.int64()), whitened], ["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "packed").mapInArrow(whiten, WHITENED)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per row of ``embeddings (vec_id, embedding)`` and component."""
    spark = embeddings.sparkSession
    rows = quantised(embeddings)
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    # A size that no row has: an empty table gives an empty result.
    rows = rows.where(F.col("size") == (sizes["size"] if sizes else -1))
    different = written(rows.select("packed").distinct(), "vectors")
    fitted = fit(different, sizes["size"], components) if sizes else None
    if fitted is None:
        fitted = Whitening(1, [0], np.zeros(0), np.zeros((1, 0)), 1.0)
    error = identity_error(different, fitted)
    explained = spark.createDataFrame(
        [(i + 1, float(e / fitted.trace)) for i, e in enumerate(fitted.eigenvalues)], "component int, explained double"
    )  # no more rows than components
    found = transform(rows, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    found = found.join(F.broadcast(explained), found.place + 1 == explained.component)
    return found.select("vec_id", "component", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
