"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words, hashed, with weights of square-root counts scaled to length one; bins of
structure statistics (case, digits, symbols, repetition, lines, word lengths); and bins of the metadata length. The machine
scores w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j; the pairs cost linear time, as half of
(sum v_if x_i)^2 - sum (v_if x_i)^2 summed over the factors f. Labels, language, source and doc_id are never inputs.

It is trained on the driver by AdaGrad on a bounded sample of labelled documents (`TRAIN_ROWS`, chosen by a hash of doc_id
among all labelled ones that aren't held out), and scores every whole text on the executors.

Defined cases: null and empty texts have only statistics and get a score; a null doc_id isn't held out, as it has no
text form, and isn't trained on; null labels aren't trained on; of several labels of a document the largest counts;
repeated documents are scored one by one; without labelled rows every score is 0.5; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, split_words, table

#: Labelled documents used for training, at most.
TRAIN_ROWS = 12_000
THRESHOLD = 0.3
WORD_SLOTS = 1 << 14
FACTORS = 8
EPOCHS = 6
RATE = 0.1
DECAY = 1e-5

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_HIGH = bytes(range(128, 256))
_SPACE = b" \t\r\n\x0b\x0c"
_END = b".,;:?'\"()-"
_ALL = bytes(range(256))
#: Bytes that neither letters, digits, spaces nor usual punctuation account for.
_ODD = bytes(c for c in range(128) if c not in _UPPER + _LOWER + _DIGIT + _SPACE + _END)

_SHARES = np.array([0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.12, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
_SIZES = np.array([1, 4, 16, 64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 65536], float)
_LENGTHS = np.array([1, 2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 14], float)
#: Statistics in the order of `statistics`, with their bins.
_BINS = [_SHARES] * 10 + [_LENGTHS, _LENGTHS, _SIZES, _SIZES, _SIZES, _SIZES]
_WIDTH = 16
STAT_SLOTS = _WIDTH * len(_BINS)
SLOTS = WORD_SLOTS + STAT_SLOTS


def _without(data: bytes, drop: bytes) -> int:
    return len(data.translate(None, drop))


def statistics(data: bytes, words: list[bytes], counts: dict[bytes, int], n_chars: int | None) -> list[float]:
    size = max(1, len(data))
    n = max(1, len(words))
    upper = size - _without(data, _UPPER)
    lower = size - _without(data, _LOWER)
    lines = data.split(b"\n")
    filled = [x for x in lines if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        upper / max(1, upper + lower),
        (size - _without(data, _DIGIT)) / size,
        (size - _without(data, _ODD)) / size,
        (size - _without(data, _END)) / size,
        (size - _without(data, _HIGH)) / size,
        1 - len(counts) / n,
        max(counts.values(), default=0) / n,
        same / n,
        1 - len(set(filled)) / max(1, len(filled)),
        data.count(b"|") / n,
        sum(map(len, words)) / n,
        sum(map(len, counts)) / max(1, len(counts)),
        float(len(words)),
        float(len(filled)),
        len(words) / max(1, len(filled)),
        float(len(data) if n_chars is None else n_chars),
    ]


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one document."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = split_words(data)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    stats = [i * _WIDTH + int(np.searchsorted(edges, x, "left")) for i, (edges, x) in enumerate(zip(_BINS, statistics(data, words, counts, n_chars), strict=True))]
    slots = np.empty(len(counts) + len(stats), np.int32)
    values = np.empty(len(slots), np.float32)
    k = len(counts)
    if k:
        crc = zlib.crc32
        slots[:k] = np.fromiter((crc(w) for w in counts), np.uint32, k) % WORD_SLOTS
        tf = np.sqrt(np.fromiter(counts.values(), np.float32, k))
        values[:k] = tf / np.sqrt(np.sum(tf * tf))
    slots[k:] = WORD_SLOTS + np.array(stats)
    values[k:] = 0.5
    return slots, values


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of documents whose slots lie end to end; starts has the first of each, and none is empty."""
        vx = self.factors[slots] * values[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + np.add.reduceat(self.linear[slots] * values, starts) + 0.5 * (sums * sums - squares).sum(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the log loss, in small batches. Rows are in a fixed order, so the result is too."""
    random = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(SLOTS, np.float32), random.normal(0, 0.01, (SLOTS, FACTORS)).astype(np.float32))
    if not rows:
        machine.factors[:] = 0
        return machine
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    machine.bias = float(np.log(share / (1 - share)))
    g_bias, g_linear, g_factors = 1e-6, np.full(SLOTS, 1e-6, np.float32), np.full((SLOTS, FACTORS), 1e-6, np.float32)
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            slots = np.concatenate([rows[i][0] for i in batch])
            x = np.concatenate([rows[i][1] for i in batch])
            sizes = np.array([len(rows[i][0]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vx = machine.factors[slots] * x[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            squares = np.add.reduceat(vx * vx, starts, axis=0)
            raw = machine.bias + np.add.reduceat(machine.linear[slots] * x, starts) + 0.5 * (sums * sums - squares).sum(axis=1)
            error = ((sigmoid(raw) - labels[batch]) / len(batch)).astype(np.float32)
            each = np.repeat(error, sizes)
            unique, where = np.unique(slots, return_inverse=True)
            d_linear = np.bincount(where, each * x, len(unique)).astype(np.float32) + DECAY * machine.linear[unique]
            d_each = (each * x)[:, None] * (np.repeat(sums, sizes, axis=0) - vx)
            d_factors = np.stack([np.bincount(where, d_each[:, f], len(unique)) for f in range(FACTORS)], axis=1).astype(np.float32) + DECAY * machine.factors[unique]
            d_bias = float(error.sum())
            g_bias += d_bias**2
            g_linear[unique] += d_linear**2
            g_factors[unique] += d_factors**2
            machine.bias -= RATE * d_bias / g_bias**0.5
            machine.linear[unique] -= RATE * d_linear / np.sqrt(g_linear[unique])
            machine.factors[unique] -= 0.5 * RATE * d_factors / np.sqrt(g_factors[unique])
    return machine


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, *, most: int = TRAIN_ROWS) -> Machine:
    """Trains on at most `most` labelled documents that aren't held out."""
    known = labels.where(labels["quality"].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    # the hash range that holds `most` rows or a few more, so that the limit below sorts little
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    near = known.where(place <= F.lit(1_000_003) * min(1.0, 1.2 * most / max(1, known.count())))
    chosen = near.orderBy(place, "doc_id").limit(most)
    sample = docs.select(docs["doc_id"], docs["text"], docs["n_chars"]).join(F.broadcast(chosen), "doc_id")

    def setup():
        def run(texts, n_chars):
            made = [features(t, n) for t, n in zip(texts.to_pylist(), n_chars.to_pylist(), strict=True)]
            return [pa.array([s.tobytes() for s, _ in made], pa.binary()), pa.array([v.tobytes() for _, v in made], pa.binary())]

        return run

    fields = [T.StructField("slots", T.BinaryType()), T.StructField("values", T.BinaryType())]
    rows = arrow_map(sample, ["text", "n_chars"], ["doc_id", "label"], fields, setup).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["slots"])))
    made = [(np.frombuffer(r["slots"], np.int32), np.frombuffer(r["values"], np.float32)) for r in rows]
    return train(made, np.array([r["label"] for r in rows], np.float32))


def scored(docs: DataFrame, machine: Machine, *, keep: list[str]) -> DataFrame:
    """Columns `keep` of docs with `quality_score`."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def setup():
        model = shared.value

        def run(texts, n_chars):
            made = [features(t, n) for t, n in zip(texts.to_pylist(), n_chars.to_pylist(), strict=True)]
            if not made:
                return [pa.array([], pa.float64())]
            starts = np.concatenate([[0], np.cumsum([len(s) for s, _ in made])[:-1]])
            raw = model.raw(np.concatenate([s for s, _ in made]), np.concatenate([v for _, v in made]), starts)
            return [pa.array(sigmoid(raw.astype(np.float64)), pa.float64())]

        return run

    return arrow_map(docs, ["text", "n_chars"], keep, [T.StructField("quality_score", T.DoubleType())], setup)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    machine = fitted(documents, table(spark, sf_dir, "labels"))
    score = F.col("quality_score")
    return scored(documents, machine, keep=["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
