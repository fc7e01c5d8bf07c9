"""The force layout: repulsion against all pairs, pulls by hand, and what a layout has to show."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.operators import forces as L


def test_repulsion_against_all_pairs(spark):
    """Forces of the pyramid on 200 nodes, of which a third lies on a heap, against the sum over all pairs."""
    r = np.random.default_rng(3)
    side = 40.0
    spots = np.concatenate([r.uniform(-20, 20, (140, 2)), r.normal(7, 0.7, (60, 2))])
    units = np.round(spots * L.UNIT).astype(int)
    places = spark.createDataFrame([(k, int(x), int(y)) for k, (x, y) in enumerate(units)], "node long, x long, y long")
    x, y = units[:, 0] / L.UNIT, units[:, 1] / L.UNIT
    got = np.array(L.pyramid_of(places, side, L.depth_of(200)).forces(x, y, np.zeros(200)))
    dx, dy = x[:, None] - x, y[:, None] - y
    square = dx**2 + dy**2 + np.eye(200)
    want = np.array([(dx / square).sum(axis=1), (dy / square).sum(axis=1)])
    off = np.hypot(*(got - want)) / np.hypot(*want)
    assert np.median(off) < 0.05 and np.quantile(off, 0.9) < 0.25
    # a finer grid has the pairs themselves, but for those in one cell
    fine = np.array(L.pyramid_of(places, side, 10).forces(x, y, np.zeros(200)))
    assert np.median(np.hypot(*(fine - want)) / np.hypot(*want)) < 0.03


def test_pulls(spark):
    """The square of an edge's length at both its ends; a hub has the sum of its edges."""
    places = spark.createDataFrame([("a", 0, 0), ("b", 3 * L.UNIT, 4 * L.UNIT), ("c", -L.UNIT, 0)], "node string, x long, y long")
    links = spark.createDataFrame([("a", "b"), ("a", "c")], "a string, b string")
    got = {r.node: (r.px / L.UNIT, r.py / L.UNIT) for r in L.pulls(places, links).collect()}
    assert got == {"a": (14.0, 20.0), "b": (-15.0, -20.0), "c": (1.0, 0.0)}


def graph(spark):
    """Two groups of twelve, all tied within, one edge between them, and isolates."""
    groups = [[f"{g}{k:02}" for k in range(12)] for g in "ab"]
    edges = [(u, v) for g in groups for k, u in enumerate(g) for v in g[k + 1 :]] + [("a00", "b00"), ("b00", "a00"), ("a01", "a01"), ("a01", "gone"), (None, "a00")]
    nodes = [*groups[0], *groups[1], "z1", "z3", "z2", "z4", "z4", None]
    return spark.createDataFrame([(n,) for n in nodes], "paper_id string"), spark.createDataFrame(edges, "src string, dst string")


@pytest.fixture(scope="module")
def laid(spark):
    nodes, edges = graph(spark)
    return {r.paper_id: (r.x, r.y) for r in L.force_layout(nodes, edges, rounds=25).collect()}


def test_layout(laid):
    assert len(laid) == 28
    inner = np.array([p for n, p in laid.items() if n[0] in "ab"])
    assert max(np.ptp(inner, axis=0)) == pytest.approx(1800) and np.allclose(inner.min(axis=0) + inner.max(axis=0), 0)
    for k in range(4):
        assert laid[f"z{k + 1}"] == pytest.approx((1050 * math.cos(math.pi * k / 2), 1050 * math.sin(math.pi * k / 2)), abs=1e-6)
    a, b = (np.array([p for n, p in laid.items() if n[0] == g]) for g in "ab")
    within = max(np.linalg.norm(g - g.mean(axis=0), axis=1).mean() for g in (a, b))
    assert np.linalg.norm(a.mean(axis=0) - b.mean(axis=0)) > 2 * within
    assert len({p for p in laid.values()}) == 28


def test_layout_is_fixed_by_its_seed(spark, laid):
    nodes, edges = graph(spark)
    again = {r.paper_id: (r.x, r.y) for r in L.force_layout(nodes.repartition(7), edges.repartition(5), rounds=25).collect()}
    assert again == laid
    other = {r.paper_id: (r.x, r.y) for r in L.force_layout(nodes, edges, rounds=2, seed=1).collect()}
    assert other["a00"] != laid["a00"] and other["z1"] == laid["z1"]


def test_small_graphs(spark):
    none = spark.createDataFrame([], "src string, dst string")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "paper_id string")
    assert L.force_layout(ids(), none).collect() == []
    assert [tuple(r) for r in L.force_layout(ids("a"), none).collect()] == [("a", 1050.0, 0.0)]
    pair = L.force_layout(ids("a", "b"), spark.createDataFrame([("a", "b")], "src string, dst string"), rounds=3).collect()
    assert len(pair) == 2 and all(math.isfinite(v) for r in pair for v in (r.x, r.y))


def test_nodes_on_one_spot_part(spark):
    places = spark.createDataFrame([(k, 0, 0) for k in range(5)], "node long, x long, y long")
    links = spark.createDataFrame([], "a long, b long")
    rows = L.moved(places, links, 10.0, 3, 1.0).agg(F.countDistinct("x", "y").alias("n")).first()
    assert rows.n == 5


def test_isolates_are_found_by_ends_that_go_once(spark, tmp_path, monkeypatch):
    """Edges and their ends are made distinct before they are joined; they repeat each node many times."""
    from citeloom.operators import forces
    from citeloom.plans import catalogue

    tables = {"supplier": "s_suppkey long", "part": "p_partkey long", "customer": "c_custkey long"}
    for name, schema in tables.items():
        spark.createDataFrame([(k,) for k in range(4)], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = [(1, 2, 50.0)] * 20 + [(3, 9, 50.0), (2, 3, 1.0)]
    spark.createDataFrame(lines, "l_suppkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, real = [], forces.isolates
    monkeypatch.setattr(forces, "isolates", lambda nodes: seen.append(nodes) or real(nodes))
    found = catalogue.queries()["isolate_circle"](spark, str(tmp_path))
    assert {r.paper_id for r in found.collect()} == {"s0", "s2", "s3", "p0", "p1", "p3", "c0", "c1", "c2", "c3"}
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") >= 2


def test_forces_of_cells_have_no_masks(monkeypatch):
    """The sums of node by node, to the last bit, with four blocks a level, not an array of masks for each cell around."""
    r = np.random.default_rng(5)
    side, depth, n = 30.0, 5, 120
    x, y = (np.round(r.uniform(-side / 2, side / 2, n) * 64) / 64 for _ in range(2))
    x[:3], y[:3] = x[0], y[0]
    angle, width = r.uniform(0, 6, n), 1 << depth
    at = lambda p, w: min(max(int((p / side + 0.5) * w), 0), w - 1)
    cells = np.array([at(a, width) * width + at(b, width) for a, b in zip(x, y, strict=True)])
    known, inverse = np.unique(cells, return_inverse=True)
    grid = L.Pyramid(side, depth, known, np.bincount(inverse).astype(float), np.bincount(inverse, x), np.bincount(inverse, y))
    want = np.zeros((2, n))
    for k in range(n):
        for level in range(2, depth + 1):
            w = 1 << level
            i, j = at(x[k], w), at(y[k], w)
            for u in range(i // 2 * 2 - 2, i // 2 * 2 + 4):
                for v in range(j // 2 * 2 - 2, j // 2 * 2 + 4):
                    if not (0 <= u < w and 0 <= v < w) or (level < depth and abs(u - i) <= 1 and abs(v - j) <= 1):
                        continue
                    own = float(level == depth and (u, v) == (i, j))
                    mass, sx, sy = grid.levels[level][:, u, v] - own * np.array([1.0, x[k], y[k]])
                    if mass > 0.5:
                        dx, dy = x[k] - sx / mass, y[k] - sy / mass
                        square = dx * dx + dy * dy
                        if square < 1e-8:
                            dx, dy, square = 1e-2 * np.cos(angle[k]), 1e-2 * np.sin(angle[k]), 1e-4
                        want[:, k] += mass / square * dx, mass / square * dy
    calls, real = [], np.flatnonzero
    monkeypatch.setattr(L.np, "flatnonzero", lambda m: calls.append(1) or real(m))
    assert np.array_equal(grid.forces(x, y, angle), want)
    assert len(calls) <= 4 * (depth - 1)
