"""Embedding whitening by matrix-free block Lanczos.

Vectors are brought to a grid of 1/256, and what is fitted are the different grid vectors x, each once. Their covariance V is
never formed: a pass over the rows, spread over all tasks, multiplies it with a block of columns B as the sum of
(x - S/n) * ((x - S/n) . B), divided by n. The driver holds only the basis, dimension x basis size.

Block Lanczos with full reorthogonalisation: the product of the last block is made orthogonal to the whole basis twice and
becomes the next block. Columns that vanish (a breakdown: the Krylov space is invariant) are restarted with random ones,
orthogonal to the basis, so that repeated eigenvalues and parts of the space that the first block had no share in are found.
The basis and its products give Ritz pairs; the norm of V y - e y is their residual. Passes end when the residuals of the
wanted pairs are below `TOLERANCE` of the largest eigenvalue, or when the basis spans the space, where the pairs are exact.

The trace of V is the sum of the rows' exact deviations, sum (n x - S)^2, over n^3: it gives explained shares without V.

Defined cases: vectors that are null, empty, hold null or non-finite entries, or entries whose grid number isn't below 2^53,
take no part; of vectors of several lengths those of the most frequent length take part, of equally frequent the longer one's;
repeated rows are fitted once and whitened each; null ids stay null; components without variance (equal vectors, fewer vectors
than dimensions) are left out, so a table of equal vectors gives no rows, and an empty table gives none; very long vectors
cost by their length, as the basis does; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, slices, table

GRID = 256
COMPONENTS = 4
#: Columns of a block: more than are wanted, as each pass reads all rows.
BLOCK = 16
TOLERANCE = 1e-13
SEED = 13
_DEPENDENT = 1e-10


def gridded(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): ids and grid numbers of the rows that take part."""
    c = F.transform(vectors[embedding], lambda v: v.cast("double") * GRID)
    rows = vectors.select(vectors[vec_id].alias("vec_id"), c.alias("c"))
    fit = rows.where(F.size("c") > 0).where(F.forall("c", lambda v: F.coalesce(F.abs(v) < float(1 << 53), F.lit(False)) & ~F.isnan(v)))
    fit = fit.select("vec_id", F.transform("c", lambda v: F.floor(v)).alias("x"))
    sizes = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    row = sizes.first()
    return fit.where(F.size("x") == (row["d"] if row else 0))


def matrix(column: pa.ListArray) -> np.ndarray:
    """A column of lists of one length as an array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def summed(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of what work(rows x dimension) gives, `size` numbers, added task by task and then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for whole in batches:
            for batch in slices(whole):
                if batch.num_rows:
                    total += work(matrix(batch.column(0))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "part"])

    parts = rows.select("x").mapInArrow(run, "place int, part double")
    got = parts.groupBy("place").agg(F.sum("part").alias("part")).toArrow()  # `size` rows, in one job
    out = np.zeros(size)
    out[got["place"].to_numpy()] = got["part"].to_numpy()
    return out


@dataclass
class Whitening:
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    #: Unit eigenvectors as columns.
    vectors: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def orthogonal(columns: np.ndarray, basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Unit columns orthogonal to the basis and to each other, for these ones; those that depend on others are drawn anew.
    There are fewer where the space has no room left."""
    size, room = columns.shape[0], columns.shape[0] - basis.shape[1]
    out = np.zeros((size, 0))
    for k in range(min(columns.shape[1], room)):
        v, scale = columns[:, k], np.linalg.norm(columns[:, k])
        for _ in range(20):
            w = v
            for _ in range(2):
                w = w - basis @ (basis.T @ w)
                w = w - out @ (out.T @ w)
            left = np.linalg.norm(w)
            if scale > 0 and left > _DEPENDENT * scale:
                break
            v = random.normal(size=size)
            scale = np.linalg.norm(v)
        w = w / left
        w = w - basis @ (basis.T @ w) - out @ (out.T @ w)
        out = np.column_stack([out, w / np.linalg.norm(w)])
    return out


def block_lanczos(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, *, block: int = BLOCK, tolerance: float = TOLERANCE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors of the symmetric matrix behind product(columns)."""
    random = np.random.default_rng(seed)
    wanted = min(wanted, size)
    basis, images = np.zeros((size, 0)), np.zeros((size, 0))
    last = orthogonal(random.normal(size=(size, max(wanted, min(block, size)))), basis, random)
    while True:
        basis = np.column_stack([basis, last])
        image = product(last)
        images = np.column_stack([images, image])
        inner = basis.T @ images
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        values, turns = values[::-1][:wanted], turns[:, ::-1][:, :wanted]
        vectors = basis @ turns
        residuals = np.linalg.norm(images @ turns - vectors * values, axis=0)
        if basis.shape[1] == size or (residuals <= tolerance * max(abs(values[0]), np.finfo(float).tiny)).all():
            return values, vectors / np.linalg.norm(vectors, axis=0)
        last = orthogonal(image, basis, random)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """sum (n x - S)^2 of every row, exactly."""
    bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if bound * bound * max(1, x.shape[1]) < 1 << 62:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]


def fitted(rows: DataFrame, *, components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Fits the whitening to the different vectors of gridded() rows; None if none has variance."""
    once = checkpointed(rows.select("x").distinct())

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, None
        for whole in batches:
            for batch in slices(whole):
                x = matrix(batch.column(0))
                if not len(x):
                    continue
                # halves of the numbers, so that sums of a batch stay within 64 bits
                part = [int(h) * (1 << 26) + int(low) for h, low in zip((x >> 26).sum(axis=0), (x & (1 << 26) - 1).sum(axis=0), strict=True)]
                sums = part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
                count += len(x)
        made = [] if sums is None else [(-1, count), *enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int32()), pa.array([Decimal(v) for _, v in made], pa.decimal128(38, 0))], names=["place", "part"])

    got = once.mapInArrow(totals, "place int, part decimal(38,0)").groupBy("place").agg(F.sum("part").cast("decimal(38,0)").alias("part"))
    found = {r["place"]: int(r["part"]) for r in got.collect()}  # a row a dimension
    if not found:
        return None
    n, size = found.pop(-1), len(found)
    sums = [found[k] for k in range(size)]
    mean = np.array([s / n for s in sums])

    def spread(x: np.ndarray) -> np.ndarray:
        return np.square(x - mean).sum(axis=0)

    if not summed(once, spread, size).any():
        return None

    def product(columns: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ columns)

        return summed(once, work, columns.size).reshape(columns.shape) / n

    values, vectors = block_lanczos(product, size, components, block=block)
    real = values > size * np.finfo(float).eps * values[0]
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    scale = vectors / np.sqrt(values)
    k = len(values)

    def square(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ scale
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    last = summed(once, square, k + k * k)
    centre = last[:k] / n
    error = np.abs(last[k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max()
    total = once.mapInArrow(_summed_deviations(n, sums), "part decimal(38,0)").agg(F.sum("part")).first()[0]
    return Whitening(n, sums, int(total) / n**3, values, vectors, float(error))


def _summed_deviations(n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                total = sum(deviations(matrix(batch.column(0)), n, sums)) if batch.num_rows else 0
                yield pa.RecordBatch.from_arrays([pa.array([Decimal(total)], pa.decimal128(38, 0))], names=["part"])

    return run


def whitened(rows: DataFrame, fit: Whitening | None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of gridded() rows, a row a component."""
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        k, scale, mean = len(fit.values), fit.vectors / np.sqrt(fit.values), fit.mean
        explained = fit.values / fit.trace
        for whole in batches:
            for batch in slices(whole):
                m = batch.num_rows
                if not m:
                    continue
                x = matrix(batch.column(1))
                exact = [Decimal(d) for d in deviations(x, fit.n, fit.sums)]
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fit.n)),
                        pa.array(exact, pa.decimal128(38, 0)).take(each),
                        pa.array(((x - mean) @ scale).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, fit.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gridded(table(spark, sf_dir, "embeddings"))
    return whitened(rows, fitted(rows)).withColumn("deviation", F.col("deviation").cast("long"))
