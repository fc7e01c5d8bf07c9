"""Steps whose time or memory would grow faster than their input: what is read, parsed, joined and held once."""

import json

import pytest
from pyspark.sql import functions as F

from citeloom.operators import backfill as B
from citeloom.operators import citations as C


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_edges_outside_a_network_go_before_the_others_are_grouped(spark):
    rows = [("a", "b", 5, "late"), ("a", "b", 2, "first"), ("b", "c", 3, "x"), ("c", "d", 4, "out"), ("a", "a", 6, "loop"), (None, "a", 7, "n"), ("a", None, 8, "n")]
    edges = spark.createDataFrame(rows, "src string, dst string, ord long, relation string")
    members = spark.createDataFrame([("a",), ("a",), ("b",)], "paper_id string")
    found = C.network_edges(edges, members)
    assert plan(found).index("Aggregate") < plan(found).index("Join")
    want = {("a", "b", 2, "first", True, True), ("b", "c", 3, "x", True, False), ("a", "a", 6, "loop", True, True)}
    assert {(r.src, r.dst, r.ord, r.relation, r.src_in, r.dst_in) for r in found.collect()} == want


def test_components_are_counted_without_their_names(spark, monkeypatch):
    from citeloom.operators import graph

    monkeypatch.setattr(graph, "connected_components", None)
    monkeypatch.setattr(C, "connected_components", None, raising=False)
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "x"), ("y", "z"), ("z", "y"), (None, "a")], "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in "abcxyzmn"], "paper_id string")
    assert tuple(C.component_stats(nodes, edges).first()) == (5, 3, 3)
    assert tuple(C.component_stats(nodes, edges.limit(0)).first()) == (8, 1, 8)
    assert tuple(C.component_stats(nodes.limit(0), edges).first()) == (0, 0, 0)
    assert tuple(C.component_stats(nodes, edges.where("src = 'x'")).first()) == (8, 1, 8)


def test_responses_are_parsed_once(spark):
    rows = [(1, json.dumps({"id": "w1", "doi": "10.1/A"})), (2, "{torn"), (3, None), (4, json.dumps({"data": [{"citedPaper": {"corpusId": "7"}}]}))]
    parsed = B.parsed_responses(spark.createDataFrame(rows, "ord long, value string"))
    assert "from_json" not in plan(parsed)
    found = {r.ord: r for r in parsed.collect()}
    assert found[1].doi == "10.1/A" and found[4].data[0].citedPaper.corpusId == "7" and 3 not in found


def test_keys_are_one_join(spark):
    papers = spark.createDataFrame([("p1", "W1", "10.1/a", 1), ("p2", "", "10.1/B", 2), ("p3", "w1", None, 3), ("p4", None, "10.1/c", 4)], "paper_id string, w string, doi string, ord long")
    found = spark.createDataFrame([(1, "W1", "10.1/c", "x"), (2, None, "10.1/b", "y"), (3, "none", "10.1/A", "z"), (4, "", None, "q")], "ord long, w string, doi string, v string")
    rows = B.matched(papers, found, ["w", "doi"])
    assert plan(rows).count("Join ") == 1
    assert {(r.ord, r.v, r.paper_id) for r in rows.collect()} == {(1, "x", "p3"), (2, "y", "p2"), (3, "z", "p1")}


@pytest.mark.parametrize("repeats", [1, 3])
def test_a_task_has_few_edges(spark, monkeypatch, repeats):
    """Tasks that make edges distinct are as many as the edges need, and none holds a whole split before."""
    monkeypatch.setattr(C, "EDGES_A_TASK", 10)
    edges = spark.range(100 * repeats).select((F.col("id") % 100).cast("string").alias("src"), F.concat(F.lit("hub"), F.col("id") % 1).alias("dst"))
    clean = C.clean_edges(edges)
    assert clean.rdd.getNumPartitions() == 10 * repeats and clean.count() == 100
    found = {r.paper_id: (r.in_degree, r.out_degree, r.degree) for r in C.degrees(clean).collect()}
    assert found["hub0"] == (100, 0, 100) and found["7"] == (0, 1, 1) and len(found) == 101
    assert C.clean_edges(edges.limit(0)).count() == 0
