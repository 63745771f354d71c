"""Whitening of embeddings, with covariances found by polarisation.

Entries become whole numbers, x = floor(1024 * c) + 100000, so every sum is exact. Vectors are centred at the whole numbers next
to the means, and what is squared and summed is each centred dimension and each sum of two of them:

    V(a) = E[a^2] - E[a]^2,    cov(a, b) = (V(a + b) - V(a) - V(b)) / 2.

The rests of the means are taken off the sums exactly. Squares are the only products of entries; their sums leave a
task as 32-bit limbs, a row for each pair of dimensions, and Spark adds these up. The matrix comes to the driver, whose size is
the square of the number of dimensions and not of the table, and ``eigh`` gives the components.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries, or one of 2^52 or more, whose x isn't a long, are
left out, and so are vectors of another length than most have (ties: the longer); rows with null or repeated ids are
rows like any other; a component without variance has whitened values of null and an explained share of 0 (null
if nothing varies) and doesn't count for the identity error, which is null if there is no other; a deviation beyond a long is
null; an empty table, or one of empty vectors, gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from rimline.llm.common import cut, table

SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no long of their own.
BOUND = float(1 << 52)
COMPONENTS = 8
#: Rows whose sums are taken at a time.
BLOCK = 512
LIMB = 32
MASK = (1 << LIMB) - 1


def finite(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, entries) of the rows whose vectors hold finite numbers only."""
    found = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("entries"))
    odd = F.exists("entries", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= BOUND))
    return found.where(F.col("entries").isNotNull() & ~odd)


def blocks(batch: pa.RecordBatch, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole numbers) of a batch's vectors, those of one length together."""
    lists = batch.column("entries")
    offsets, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False)
    starts, sizes = offsets[:-1], np.diff(offsets)
    for length in np.unique(sizes) if size is None else [size]:
        places = np.flatnonzero(sizes == length)
        for at in range(0, len(places), BLOCK):
            some = places[at : at + BLOCK]
            entries = flat[starts[some][:, None] + np.arange(length)]
            yield some, np.floor(entries * SCALE).astype(np.int64) + SHIFT


class Sums:
    """Exact sums of arrays of whole numbers, as 32-bit halves that can't overflow."""

    def __init__(self) -> None:
        self.high, self.low = 0, 0

    def add(self, values: np.ndarray) -> None:
        self.high, self.low = self.high + (values >> LIMB), self.low + (values & MASK)

    def limbs(self) -> Iterator[tuple[int, int, int]]:
        """(place, limb, part): the parts times 2^32 to the limbs add up to the sum at a place."""
        for place, (high, low) in enumerate(zip(np.ravel(self.high).tolist(), np.ravel(self.low).tolist())):
            limb, rest = 0, (high << LIMB) + low
            while rest not in (0, -1):
                yield place, limb, rest & MASK
                limb, rest = limb + 1, rest >> LIMB
            if rest:
                yield place, limb, rest


def _added(rows: Iterable[tuple[int, int, int]]) -> int:
    return sum(part << (LIMB * limb) for limb, part in rows)


def _columns(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], names=list(kinds))


def means(vectors: DataFrame) -> tuple[int, int, list[int]] | None:
    """(dimensions, n, S): of the vectors of the commonest length, how many there are and the sum of each dimension."""
    kinds = {"size": pa.int32(), "place": pa.int32(), "limb": pa.int32(), "part": pa.int64()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, Sums] = {}
        for batch in batches:
            for places, x in blocks(batch):
                size = x.shape[1]
                counts[size] = counts.get(size, 0) + len(places)
                # Halves first: a block's sum of large numbers has no long.
                for shift, half in ((LIMB, x >> LIMB), (0, x & MASK)):
                    added = half.sum(axis=0)
                    sums.setdefault(size, Sums()).add(added.astype(object) << shift if shift and added.any() else added << shift)
        for size, n in counts.items():
            yield _columns([(size, -1, 0, n), *((size, *row) for row in sums[size].limbs())], kinds)

    found = vectors.select("entries").mapInArrow(run, "size int, place int, limb int, part long")
    found = cut(found.groupBy("size", "place", "limb").agg(F.sum("part").alias("part")))
    most = found.where("place = -1").orderBy(F.desc("part"), F.desc("size")).first()
    if most is None or not most["size"]:
        return None
    parts: dict[int, list] = {}
    for row in found.where((F.col("size") == most["size"]) & (F.col("place") >= 0)).collect():
        parts.setdefault(row["place"], []).append((row["limb"], row["part"]))
    return most["size"], most["part"], [_added(parts.get(place, ())) for place in range(most["size"])]


def squares(vectors: DataFrame, size: int, centre: list[int]) -> dict[tuple[int, int], int]:
    """The exact sums of squares of each centred dimension, at (a, a), and of each sum of two, at (a, b) with a < b."""
    kinds = {"a": pa.int32(), "b": pa.int32(), "limb": pa.int32(), "part": pa.int64()}
    middle = np.array(centre, np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [Sums() for _ in range(size)]
        for batch in batches:
            for _, x in blocks(batch, size):
                y = x - middle
                largest = int(np.abs(y).max(initial=0))
                if 4 * largest * largest * BLOCK >= 1 << 62:
                    y = y.astype(object)
                for a in range(size):
                    pairs = y[:, a:] + y[:, a : a + 1]
                    pairs[:, 0] = y[:, a]
                    sums[a].add((pairs * pairs).sum(axis=0) if y.dtype == object else np.einsum("ij,ij->j", pairs, pairs))
        for a in range(size):
            yield _columns([(a, a + place, limb, part) for place, limb, part in sums[a].limbs()], kinds)

    found = vectors.select("entries").mapInArrow(run, "a int, b int, limb int, part long")
    parts: dict[tuple[int, int], list] = {}
    for row in found.groupBy("a", "b", "limb").agg(F.sum("part").alias("part")).collect():
        parts.setdefault((row["a"], row["b"]), []).append((row["limb"], row["part"]))
    return {(a, b): _added(parts.get((a, b), ())) for a in range(size) for b in range(a, size)}


def covariance(n: int, rests: list[int], found: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances by polarisation: halves of what the variance of a sum has beyond those of its terms."""
    size = len(rests)
    # n^2 times the variances, as whole numbers.
    alone = [n * found[a, a] - rests[a] ** 2 for a in range(size)]
    matrix = np.empty((size, size))
    for a in range(size):
        matrix[a, a] = alone[a] / (n * n)
        for b in range(a + 1, size):
            together = n * found[a, b] - (rests[a] + rests[b]) ** 2
            matrix[a, b] = matrix[b, a] = (together - alone[a] - alone[b]) / (2 * n * n)
    return matrix


@dataclass(frozen=True)
class Whitening:
    """What turns vectors into whitened ones: x less centre, less rests / n, times weights."""

    size: int
    n: int
    centre: list[int]
    rests: list[int]
    weights: np.ndarray
    explained: list[float | None]
    varies: list[bool]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.centre, np.int64) - np.array([r / self.n for r in self.rests])) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums of squares of n * x - S; null beyond a long."""
        y = x - np.array(self.centre, np.int64)
        reach = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rests), default=0)
        if self.size * reach * reach >= 1 << 63:
            y = y.astype(object)
        off = y * self.n - np.array(self.rests, y.dtype)
        return [d if d < 1 << 63 else None for d in (off * off).sum(axis=1).tolist()]


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of all vectors; none if there are no dimensions."""
    found = means(vectors)
    if found is None:
        return None
    size, n, sums = found
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rests = [s - n * m for s, m in zip(sums, centre)]
    matrix = covariance(n, rests, squares(vectors, size, centre))
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    # Of the two signs that which makes the largest entry positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    total = float(np.trace(matrix))
    varies = values > size * np.finfo(float).eps * total
    scales = np.where(varies, np.sqrt(np.where(varies, values, 1.0)), np.inf)
    shares = [float(max(e, 0.0) / total) if total > 0 else None for e in values]
    return Whitening(size, n, centre, rests, axes / scales, shares, varies.tolist())


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """The largest entry, without sign, of the whitened vectors' covariance less the identity."""
    kinds = {"a": pa.int32(), "b": pa.int32(), "part": pa.float64()}
    count = model.weights.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            for _, x in blocks(batch, model.size):
                w = model.whitened(x)
                products += w.T @ w
                sums += w.sum(axis=0)
        rows = [(a, b, products[a, b]) for a in range(count) for b in range(count)]
        yield _columns([*rows, *((a, -1, sums[a]) for a in range(count))], kinds)

    found = vectors.select("entries").mapInArrow(run, "a int, b int, part double").groupBy("a", "b").agg((F.sum("part") / model.n).alias("mean"))
    mean = {(r["a"], r["b"]): r["mean"] for r in found.collect()}
    real = [a for a in range(count) if model.varies[a]]
    return max((abs(mean[a, b] - mean[a, -1] * mean[b, -1] - (a == b)) for a in real for b in real), default=None)


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row for each vector and leading component: the vector's coordinate there, scaled to variance 1."""
    from pyspark.sql.pandas.types import to_arrow_schema

    vectors = finite(rows, vector, key)
    kinds = (("component", IntegerType()), ("n", LongType()), ("deviation", LongType()), ("whitened", DoubleType()), ("explained", DoubleType()), ("identity_error", DoubleType()))
    schema = StructType([StructField("vec_id", vectors.schema["vec_id"].dataType), *(StructField(name, kind) for name, kind in kinds)])
    model = fitted(vectors, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model)
    arrow, count = to_arrow_schema(schema), model.weights.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in blocks(batch, model.size):
                values = model.whitened(x)
                values = [v if model.varies[i % count] else None for i, v in enumerate(values.ravel().tolist())]
                columns = [
                    batch.column("vec_id").take(pa.array(np.repeat(places, count))),
                    np.tile(np.arange(1, count + 1), len(places)),
                    np.full(len(values), model.n),
                    np.repeat(np.array(model.deviations(x), object), count).tolist(),
                    values,
                    model.explained * len(places),
                    [error] * len(values),
                ]
                yield pa.RecordBatch.from_arrays([columns[0].cast(arrow[0].type), *(pa.array(c, f.type) for c, f in zip(columns[1:], list(arrow)[1:]))], schema=arrow)

    return vectors.mapInArrow(run, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
