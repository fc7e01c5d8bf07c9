"""Toxicity by non-negative positive-unlabelled learning.

Known toxic documents are the positive examples P; all other text is unlabelled U, a mixture of both kinds with the class
prior as the share of toxic ones. With a classifier f and the logistic loss, the risk that a fully labelled sample would have
is prior * E_P[loss(f, +)] + E_U[loss(f, -)] - prior * E_P[loss(f, -)]. The last two terms are the negative class's risk and
can't be below zero; on a small sample a flexible classifier pushes them there. So where a batch's negative part is below
zero, the step goes the other way on that part alone (non-negative estimator).

The classifier is linear in what a text holds: its words and their beginnings, of `BEGINNINGS` bytes, hashed (crc32, not
folded, so that hardly two share a weight). Only those take part that toxic documents hold much more often than text at
large: in `LEAST` of them at least, `CLEAR` deviations above what chance gives. Their weights aren't negative, so harmless
words don't outvote others, however long the text is. The risk is that of the whole samples in every step, as the negative
part of a small batch falls below zero by chance; the steps' second half is averaged.

It is fitted with numpy on the driver, on bounded samples: `POSITIVES` toxic documents and `UNLABELLED` of all, chosen by a
hash, each with `SAMPLE_SLOTS` different slots at most, chosen by a hash too. Every whole text is scored, in stretches, by the
tasks. The prior is a parameter; if none is given it is the share of toxic ones among the known labels.

Defined cases: null and empty texts have no words and score as the bias says; texts of any length are scored whole in
bounded memory; a null doc_id isn't held out and isn't learned from; null labels are unknown; of several labels of a document
the largest counts; repeated rows are scored one by one; without a toxic example every score is 0; empty tables give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BYTES, arrow_map, table

#: Documents that the classifier is fitted on, at most, and different slots of each.
POSITIVES, UNLABELLED = 3_000, 8_000
SAMPLE_SLOTS = 4_000
THRESHOLD = 0.7
BEGINNINGS = range(4, 9)
#: Toxic documents that hold a slot, and deviations above chance, at least.
LEAST, CLEAR = 4, 5.0
STEPS = 400
RATE = 0.3
#: Bytes of a text whose words are listed at a time.
STRETCH = 1 << 20


def slots_of(text: bytes | None, most: int = STRETCH) -> np.ndarray:
    """Slots of the different words of a whole text and of their beginnings, sorted. Words are lower-cased runs of letters,
    digits and non-ASCII characters."""
    parts, at = [np.zeros(0, np.uint32)], 0
    while text and at < len(text):
        end = at + most
        while end < len(text) and WORD_BYTES[text[end]] != 32:
            end += 1
        words = set(text[at:end].translate(WORD_BYTES).split())
        for n in BEGINNINGS:
            words |= {w[:n] + b"*" for w in words if len(w) > n and w[-1] != 42}
        parts.append(np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words))))
        at = end
    return np.unique(np.concatenate(parts)) if len(parts) > 2 else parts[-1]


@dataclass
class Linear:
    """Weights of sorted slots."""

    bias: float
    slots: np.ndarray
    weights: np.ndarray

    def raw(self, slots: np.ndarray) -> float:
        at = np.searchsorted(self.slots, slots)
        at[at == len(self.slots)] = 0
        hit = self.slots[at] == slots if len(self.slots) else np.zeros(len(slots), bool)
        return self.bias + float(self.weights[at[hit]].sum())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def clear_slots(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Slots that toxic documents hold clearly more often than all documents do."""
    slots, n = np.unique(np.concatenate(positive), return_counts=True)
    slots, n = slots[n >= LEAST], n[n >= LEAST]
    if not len(slots):
        return slots
    every, m = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(every, slots), len(every) - 1) if len(every) else np.zeros(len(slots), int)
    other = np.where(every[at] == slots, m[at], 0) if len(every) else np.zeros(len(slots), int)
    share = (n + other) / (len(positive) + len(unlabelled))
    chance = np.sqrt(len(positive) * share * (1 - share))
    return slots[n - len(positive) * share >= CLEAR * chance]


def held(rows: list[np.ndarray], slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which document holds which of the slots, by their places."""
    ranks = [np.flatnonzero(np.isin(slots, r, assume_unique=True)) for r in rows]
    return np.repeat(np.arange(len(rows)), [len(r) for r in ranks]), np.concatenate(ranks) if ranks else np.zeros(0, int)


def risk(raw_p: np.ndarray, raw_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the estimated risk: of the positive class, and of the negative class, which may be below zero."""
    return prior * softplus(-raw_p).mean(), softplus(raw_u).mean() - prior * softplus(raw_p).mean()


def gradient(raw_p: np.ndarray, raw_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives by the raw scores of positive and unlabelled documents under the non-negative estimator."""
    p, u = sigmoid(raw_p), sigmoid(raw_u)
    if risk(raw_p, raw_u, prior)[1] < 0:  # away from a negative risk below zero
        return prior * p / len(p), -u / len(u)
    return (prior * (p - 1) - prior * p) / len(p), u / len(u)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Linear:
    """AdaGrad on the risk of all rows, with weights of zero or more."""
    slots = clear_slots(positive, unlabelled)
    own_p, of_p = held(positive, slots)
    own_u, of_u = held(unlabelled, slots)
    n_p, n_u = len(positive), len(unlabelled)
    weights, squares, mean = np.zeros(len(slots)), np.full(len(slots), 1e-8), np.zeros(len(slots))
    bias, bias_square, bias_mean = float(np.log(prior / (1 - prior))), 1e-8, 0.0
    for step in range(STEPS):
        d_p, d_u = gradient(bias + np.bincount(own_p, weights[of_p], n_p), bias + np.bincount(own_u, weights[of_u], n_u), prior)
        slope = np.bincount(of_p, d_p[own_p], len(slots)) + np.bincount(of_u, d_u[own_u], len(slots))
        squares += slope**2
        weights = np.maximum(0, weights - RATE * slope / np.sqrt(squares))
        d_bias = float(d_p.sum() + d_u.sum())
        bias_square += d_bias**2
        bias -= RATE * d_bias / bias_square**0.5
        if 2 * step >= STEPS:
            mean += weights / (STEPS - STEPS // 2)
            bias_mean += bias / (STEPS - STEPS // 2)
    kept = np.flatnonzero(mean)
    return Linear(bias_mean, slots[kept], mean[kept])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, *, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Linear | None:
    """The classifier from known toxic documents that aren't held out, and from any documents that aren't held out."""
    known = labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, clean = known.agg(F.coalesce(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.lit(0)), F.coalesce(F.sum(F.when(F.col("toxic") > 0, 0).otherwise(1)), F.lit(0))).first()
    if not toxic:
        return None
    if prior is None:
        prior = toxic / (toxic + clean) if clean else 0.1
    prior = min(0.99, max(0.001, prior))
    rows = docs.where(docs["doc_id"].isNotNull() & ~held_out(docs["doc_id"])).select(docs["doc_id"], docs["text"])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))

    def chosen(found: DataFrame, total: int, most: int) -> list[np.ndarray]:
        """Slots of `most` rows, the first in the order of a hash. Only the range of hashes that holds them is sorted; a row
        that is repeated very often is one example."""
        near = found.where(place <= F.lit(1_000_003) * min(1.0, 1.2 * most / max(1, total)))
        picked = near.distinct().orderBy(place, "doc_id", F.xxhash64("text")).limit(most)

        def setup():
            def run(texts):
                made = [slots_of(t.as_py()) for t in texts]
                few = [np.sort(s[np.argsort(mixed(s), kind="stable")[:SAMPLE_SLOTS]]) if len(s) > SAMPLE_SLOTS else s for s in made]
                return [pa.array([s.tobytes() for s in few], pa.binary())]

            return run

        made = arrow_map(picked.withColumn("text", F.col("text").cast("binary")), ["text"], ["doc_id"], [T.StructField("slots", T.BinaryType())], setup)
        got = sorted((r["doc_id"], bytes(r["slots"])) for r in made.toLocalIterator())
        return [np.frombuffer(s, np.uint32) for _, s in got]

    bad = known.where("toxic > 0").select("doc_id")
    p = chosen(rows.join(bad, "doc_id", "left_semi"), toxic, positives)
    if not p:
        return None
    # unlabelled text is all text: toxic documents, known ones too, are part of it in their share
    return train(p, chosen(rows, rows.count(), unlabelled), prior)


def mixed(slots: np.ndarray) -> np.ndarray:
    """Another hash of a hash, to choose by."""
    return slots * np.uint32(2654435761)


def scored(docs: DataFrame, model: Linear | None, *, keep: list[str]) -> DataFrame:
    """Columns `keep` of docs with `toxicity`, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        model = shared.value

        def run(texts):
            if model is None:
                return [pa.array(np.zeros(len(texts)))]
            return [pa.array(sigmoid(np.array([model.raw(slots_of(t.as_py())) for t in texts], np.float64)))]

        return run

    rows = docs.select(*[docs[c] for c in dict.fromkeys([*keep, "text"])]).withColumn("__bytes", F.col("text").cast("binary"))
    return arrow_map(rows, ["__bytes"], keep, [T.StructField("toxicity", T.DoubleType())], setup)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fitted(documents, table(spark, sf_dir, "labels"))
    score = F.col("toxicity")
    return scored(documents, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
