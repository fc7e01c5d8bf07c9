"""Positive-unlabelled learning: the risk by hand, a planted vocabulary, held-out rows, and scores worked out plainly."""

import random
import zlib

import numpy as np
import pytest

from citeloom.llm import toxicity

from .helpers import documents, words

BAD = ["vile", "scurvy", "zank"]


def corpus(n=900):
    r = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        text = words(r.choice([20, 60, 200]), k)
        toxic = k % 6 == 0
        if toxic:
            parts = text.split()
            parts[r.randrange(len(parts))] = r.choice(BAD)
            text = " ".join(parts)
        rows.append((k, text))
        if k // 6 % 2:  # half of all are labelled, whatever they are
            labels.append((k, 1, int(toxic)))
    return rows, labels


def trained(spark):
    rows, labels = corpus()
    docs = documents(spark, rows, extra=True)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, docs, known, toxicity.fitted(docs, known)


def test_finds_toxic_documents(spark):
    rows, docs, known, model = trained(spark)
    found = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(docs, model, keep=["doc_id"]).collect()}
    hidden = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    toxic = [k for k in hidden if k % 6 == 0]
    assert min(found[k] for k in toxic) >= toxicity.THRESHOLD
    assert max(found[k] for k in hidden if k % 6) < toxicity.THRESHOLD
    # a long harmless text doesn't outvote a word, nor does it add up
    long = words(30_000, 77, 500)
    extra = documents(spark, [(1, long), (2, long + " scurvy"), (3, None), (4, ""), (None, "vile")])
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(extra, model, keep=["doc_id"]).collect()}
    assert score[2] >= toxicity.THRESHOLD > score[1] and score[3] == score[4] < toxicity.THRESHOLD <= score[None]


def test_scores_plainly(spark):
    rows, docs, _, model = trained(spark)
    found = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(docs, model, keep=["doc_id"]).collect()}
    for k, text in rows[::50]:
        weights = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
        held = {w.encode() for w in text.split()}
        held |= {w[:n] + b"*" for w in set(held) for n in range(4, 9) if len(w) > n}
        raw = model.bias + sum(weights.get(zlib.crc32(w), 0.0) for w in held)
        assert found[k] == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-9)
    assert toxicity.fitted(docs, spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")) is None


def test_gradient():
    """Against differences of the risk, on both sides of zero."""
    r = np.random.default_rng(0)
    for prior, shift in ((0.3, 1.0), (0.3, -6.0)):
        p, u = r.normal(size=5) + 3, r.normal(size=7) + shift
        below = toxicity.risk(p, u, prior)[1] < 0
        assert below == (shift < 0)

        def whole(p, u, prior=prior, below=below):
            plus, minus = toxicity.risk(p, u, prior)
            return -minus if below else plus + minus

        d_p, d_u = toxicity.gradient(p, u, prior)
        for x, d, at in [(p, d_p, k) for k in range(5)] + [(u, d_u, k) for k in range(7)]:
            step = np.zeros(len(x))
            step[at] = 1e-6
            up, down = (whole(x + step, u), whole(x - step, u)) if x is p else (whole(p, x + step), whole(p, x - step))
            assert (up - down) / 2e-6 == pytest.approx(d[at], abs=1e-8)


def test_label_rules(spark):
    """Held-out labels, null ids and null labels are never learned from; several labels of a row and repeated rows are."""
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 3 == 1)
    free = [k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1][:40]
    schema = "doc_id long, quality int, toxic int"
    docs = documents(spark, [(held, "vile"), (None, "vile"), *[(k, f"a b{k}") for k in free], *[(free[0], "vile b")] * 50])
    assert toxicity.fitted(docs, spark.createDataFrame([(held, 1, 1), (None, 1, 1), (free[0], 1, None)], schema)) is None
    model = toxicity.fitted(docs, spark.createDataFrame([(free[0], 1, 0), (free[0], 1, 1), (free[1], 0, 0)], schema))
    assert model is not None
    assert toxicity.scored(documents(spark, []), model, keep=["doc_id"]).collect() == []
    rows = toxicity.scored(documents(spark, [(1, "vile"), (1, "vile")]), model, keep=["doc_id"]).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_beginnings_and_stretches():
    text = (" ".join(f"Word{k}" for k in range(3000)) + "é" * 50).encode()
    words = {w.lower().encode() for w in text.decode().split()}
    want = sorted({zlib.crc32(w) for w in words} | {zlib.crc32(w[:n] + b"*") for w in words for n in range(4, 9) if len(w) > n})
    assert toxicity.slots_of(text).tolist() == want == toxicity.slots_of(text, 64).tolist()
    assert toxicity.slots_of(None).tolist() == toxicity.slots_of(b"").tolist() == toxicity.slots_of(b" .").tolist() == []
