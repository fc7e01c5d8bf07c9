"""Whitening against a dense eigendecomposition, on tables and on matrices that break Lanczos down."""

import math

import numpy as np
import pytest

from citeloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def dense(rows):
    """Grid vectors, mean, falling eigenvalues and vectors of the different ones, all in one place."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in row] for row in rows], float)
    once = np.unique(x, axis=0)
    mean = once.mean(axis=0)
    cov = (once - mean).T @ (once - mean) / len(once)
    values, vectors = np.linalg.eigh(cov)
    return x, once, mean, cov, values[::-1], vectors[:, ::-1]


def run(df, **more):
    rows = whitening.gridded(df)
    return whitening.whitened(rows, whitening.fitted(rows, **more)).collect()


def test_against_dense(spark):
    r = np.random.default_rng(1)
    data = (r.normal(size=(300, 12)) @ r.normal(size=(12, 12)) * 0.3).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(data)] + [(1000 + k, data[k % 7].tolist()) for k in range(100)]
    bad = [(5000, None), (5001, []), (5002, [float("nan")] * 12), (5003, [math.inf] + [0.0] * 11), (5004, [None] + [0.0] * 11), (5005, [1.0]), (5006, [3e38] * 12)]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "'x' AS x", "1 AS n", "2 AS component").repartition(5)
    found = run(df, block=4)
    x, once, mean, cov, values, vectors = dense([v for _, v in rows])
    assert len(found) == 4 * len(rows) and {f["vec_id"] for f in found} == {k for k, _ in rows}
    by = {(f["vec_id"], f["component"]): f for f in found}
    for c in range(1, 5):
        want = (x - mean) @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        got = np.array([by[k, c]["whitened"] for k, _ in rows])
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-9
        assert by[0, c]["explained"] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
    n, sums = len(once), [int(s) for s in once.sum(axis=0)]
    for k, row in enumerate(x.astype(int).tolist()):
        f = by[rows[k][0], 1]
        assert f["deviation"] == sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) and f["n"] == n
    assert max(f["identity_error"] for f in found) < 1e-9


def test_few_components(spark):
    """Equal vectors have no component, vectors on a line one; an empty table has no rows."""
    assert run(spark.createDataFrame([(k, [0.5, 0.25]) for k in range(5)], SCHEMA)) == []
    assert run(spark.createDataFrame([], SCHEMA)) == []
    line = run(spark.createDataFrame([(k, [k / 256, 2 * k / 256, 0.0]) for k in range(5)] + [(None, [0.0, 0.0, 0.0])], SCHEMA))
    assert len(line) == 6 and {f["component"] for f in line} == {1} and all(f["explained"] == pytest.approx(1) for f in line)


def test_exact_deviations():
    x = np.array([[10**9, -(10**9)], [3, 4]])
    sums = [10**12 + 7, -5]
    assert whitening.deviations(x, 10**6, sums) == [sum((10**6 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert whitening.deviations(np.array([[1, 2]]), 3, [3, 6]) == [0]


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 1, 1, 0], [9, 9, 3, 3, 3, 0, 0, 0], [1] * 8, [8, 7, 6, 5, 4, 3, 2, 1]])
@pytest.mark.parametrize("block", [1, 3, 8])
def test_breakdown(values, block):
    """Repeated eigenvalues end the Krylov space early: it is restarted until all wanted ones are found."""
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(8, 8)))
    a = q @ np.diag(values).astype(float) @ q.T
    got, vectors = whitening.block_lanczos(lambda b: a @ b, 8, 4, block=block)
    assert np.allclose(got, sorted(values, reverse=True)[:4], atol=1e-11)
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-11) and np.allclose(a @ vectors, vectors * got, atol=1e-11)


def test_breakdown_below_the_first_block():
    """A start inside an invariant space that lacks the largest eigenvalue."""
    a = np.diag([1.0, 2.0, 3.0, 50.0, 40.0, 30.0])
    start = np.eye(6)[:, :3]
    random = np.random.default_rng(0)
    again = whitening.orthogonal(a @ start, start, random)
    assert again.shape == (6, 3) and np.allclose(start.T @ again, 0, atol=1e-12) and np.allclose(again.T @ again, np.eye(3))
    assert whitening.orthogonal(start, np.eye(6)[:, :5], random).shape == (6, 1)


def test_early_end():
    """Clear leading values converge before the basis spans the space."""
    r = np.random.default_rng(4)
    q, _ = np.linalg.qr(r.normal(size=(200, 200)))
    values = np.concatenate([[1000.0, 500, 250, 125], r.uniform(0, 1, 196)])
    a, passes = q @ np.diag(values) @ q.T, []
    got, _ = whitening.block_lanczos(lambda b: passes.append(b.shape[1]) or a @ b, 200, 4)
    assert np.allclose(got, values[:4], rtol=1e-12) and sum(passes) < 200


def test_sums_come_in_one_job_however_many_partitions(spark):
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {c: spark.conf.get(c) for c in conf}
    rows = spark.createDataFrame([([k, 2 * k],) for k in range(100)], "x array<long>")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    try:
        for c, value in conf.items():
            spark.conf.set(c, value)
        before = jobs()
        assert whitening.summed(rows, lambda x: x.sum(axis=0), 2).tolist() == [4950, 9900]
        assert jobs() - before < 8
    finally:
        for c, value in old.items():
            spark.conf.set(c, value)
