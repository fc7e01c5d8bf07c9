"""Approximate nearest neighbours by collision-counting hashing.

Every vector, scaled to length one, is projected on single random lines. For each line the projections of a block of rows
are a sorted array. A query opens a window around its own projection in each array and counts how often a row falls into
one. Rows that have collided in at least `THRESHOLD` of the lines are verified: their cosine is computed in double precision
on the original vectors. Virtual rehashing widens all windows by a factor until they reach as far as the k-th best verified
row asks: the projections of two rows at a distance d differ by a normal variable of deviation d on each line, so with a half
width of `REACH` times the k-th best distance, a row that is nearer is verified with a probability of `FOUND` at least. That
holds for blocks of any size and for any vectors.

Rows are indexed in blocks of at most `BLOCK_ROWS` rows and `BLOCK_BYTES`, each by the task that holds it, so all rows are indexed and no index
outgrows a task. A block is indexed once for all queries of a pass, `PASS_BYTES` of them at most, which are broadcast; the
best rows of all blocks are ranked together. The lines are drawn from a seed, so nothing is fitted.

What a query walks depends on the data: with d the k-th best distance, each line gives the rows whose projection is within
REACH * d. Vectors in clusters have near neighbours and short windows; for vectors drawn at random in many dimensions, where
the k-th best is hardly nearer than all others, windows hold most rows, as they must for the recall that is asked for.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, neither as queries nor as
candidates; neither do rows with a null id, nor candidates of another length than the query; rows with a query's own id
are no candidates of it; of query rows with one id the smallest usable vector counts, by its components in order; repeated candidates count each; ties go to the smaller id; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, slices, table

LINES = 64
#: Windows in which a candidate is found, at least.
THRESHOLD = 34
#: First half width of a window, and the factor of virtual rehashing.
HALF_WIDTH = 0.1
FACTOR = 1.3
#: Probability that a row no farther than the k-th best verified one is verified too, at least.
FOUND = 0.98
BLOCK_ROWS = 1 << 16
#: Bytes of the vectors of a block; a worker takes some four times as much.
BLOCK_BYTES = 48 << 20
#: Queries of one pass over all rows, in bytes, and how many widen their windows together.
PASS_BYTES = 16 << 20
QUERY_ROWS = 1 << 11
SEED = 5


def usable(values: list) -> np.ndarray | None:
    """The vector in double precision, or None if it takes no part."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    out = np.array(values, np.float64)
    return out if np.isfinite(out).all() and out.any() else None


def lines_of(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).normal(size=(size, LINES))


def reach_of(found: float) -> float:
    """Half width over distance with which a row collides in THRESHOLD of the lines with this probability."""
    low, high = 0.0, 8.0
    for _ in range(50):
        half = (low + high) / 2
        hit = erf(half / 2**0.5)
        chance = sum(comb(LINES, m) * hit**m * (1 - hit) ** (LINES - m) for m in range(THRESHOLD, LINES + 1))
        low, high = (half, high) if chance < found else (low, half)
    return high


REACH = reach_of(FOUND)


class Block:
    """Sorted projections of the vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = lines_of(vectors.shape[1])
        places = (vectors / self.norms[:, None]) @ self.unit
        self.order = np.argsort(places, axis=0, kind="stable").astype(np.int32).T.copy()
        self.places = np.take_along_axis(places.T, self.order, axis=1)

    def nearest(self, queries: dict[int, np.ndarray], k: int) -> Iterator[tuple[int, int, float]]:
        """(query, id, score) of the k best candidates of each query."""
        names = list(queries)
        for at in range(0, len(names), QUERY_ROWS):
            yield from self._together({q: queries[q] for q in names[at : at + QUERY_ROWS]}, k)

    def _together(self, queries: dict[int, np.ndarray], k: int) -> Iterator[tuple[int, int, float]]:
        n, names, data = len(self.ids), list(queries), np.array(list(queries.values()))
        norms = np.sqrt((data * data).sum(axis=1))
        places = (data / norms[:, None]) @ self.unit
        left, half = list(range(len(names))), np.full(len(names), HALF_WIDTH)
        while left:
            wide = half[left]
            low = np.array([np.searchsorted(p, x - wide, "left") for p, x in zip(self.places, places[left].T, strict=True)])
            high = np.array([np.searchsorted(p, x + wide, "right") for p, x in zip(self.places, places[left].T, strict=True)])
            total = (high - low).sum(axis=0)
            more = []
            for j, q in enumerate(left):
                whole = total[j] == n * LINES
                if total[j] < THRESHOLD * min(n, k):  # too few collisions for k rows
                    half[q] *= FACTOR
                    more.append(q)
                    continue
                inside = np.concatenate([o[a:b] for o, a, b in zip(self.order, low[:, j].tolist(), high[:, j].tolist(), strict=True)])
                found = np.flatnonzero(np.bincount(inside, minlength=n) >= THRESHOLD)
                found = found[self.ids[found] != names[q]]
                if len(found) < k and not whole:
                    half[q] *= FACTOR
                    more.append(q)
                    continue
                score = (self.vectors[found] * data[q]).sum(axis=1) / (self.norms[found] * norms[q])
                best = np.lexsort((self.ids[found], -score))[:k]
                # the distance of unit vectors; REACH times it is as wide as the windows have to be
                asked = REACH * np.sqrt(max(0.0, 2 - 2 * score[best[-1]])) if len(best) else 0.0
                if half[q] < asked and not whole:
                    half[q] = min(half[q] * FACTOR, asked)
                    more.append(q)
                    continue
                for at in best:
                    yield names[q], int(self.ids[found[at]]), float(score[at])
            left = more


def nearest(
    vectors: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k nearest rows of `vectors`, nearest first."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].alias("embedding")).where("vec_id is not null")
    asked = queries.select(queries[vec_id].cast("long").alias("query_id"), queries[embedding].alias("embedding")).where("query_id is not null")
    size = asked.agg(F.coalesce(F.sum(8 * F.size("embedding")), F.lit(0))).first()[0]
    batches = max(1, -(-size // max(1, pass_bytes // 2)))  # batches by hash differ in size
    found = None
    for batch in range(batches):
        rest = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(batches)) == batch).toArrow()
        mine: dict[int, np.ndarray] = {}
        for part in rest.to_batches(max_chunksize=QUERY_ROWS):
            for q, value in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if (vector := usable(value)) is not None and (q not in mine or vector.tolist() < mine[q].tolist()):
                    mine[q] = vector
        shared = spark.sparkContext.broadcast(mine)

        def search(chunks, shared=shared):
            hold: dict[int, tuple[list, list]] = {}
            size_held = 0

            def answer():
                out = []
                for size, (ids, data) in hold.items():
                    block = Block(np.array(ids, np.int64), np.array(data))
                    mine = {q: v for q, v in shared.value.items() if len(v) == size}
                    out += block.nearest(mine, k) if mine else []
                hold.clear()
                kinds = (pa.int64(), pa.int64(), pa.float64())
                return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=["query_id", "vec_id", "score"])

            for chunk in (part for whole in chunks for part in slices(whole)):
                for i, value in zip(*[c.to_pylist() for c in chunk.columns], strict=True):
                    if (vector := usable(value)) is not None:
                        ids, data = hold.setdefault(len(vector), ([], []))
                        ids.append(i)
                        data.append(vector)
                        size_held += vector.nbytes
                        if len(ids) >= BLOCK_ROWS or size_held >= BLOCK_BYTES:
                            yield answer()
                            size_held = 0
            if hold:
                yield answer()

        part = rows.mapInArrow(search, "query_id long, vec_id long, score double")
        if batches > 1:
            part = checkpointed(part)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest(embeddings, embeddings.where("vec_id % 50 = 0"))
