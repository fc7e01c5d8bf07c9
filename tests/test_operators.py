"""Operators on small hand-made tables."""

import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators import catalog as K
from citeloom.operators import citations as C
from citeloom.operators import communities as M
from citeloom.operators import corpus as R
from citeloom.operators import graph
from citeloom.operators import labels as L
from citeloom.operators import layout as G
from citeloom.operators import papers as P
from citeloom.operators import titles as S

LOG = "paper_id string, category string, tier int, classified_at string, confidence string, is_core boolean, ord long"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_reduction(spark):
    log = spark.createDataFrame(
        [
            ("a", "fmri_gnn", None, "2024", None, None, 0),
            ("a", "out_of_scope", 0, "2020", None, None, 1),
            ("b", "x", 3, "2020", None, None, 2),
            ("b", "y", 1, "2025", None, None, 3),
            ("c", "first", 1, None, None, None, 4),
            ("c", "second", 1, None, None, True, 5),
            (None, "z", 1, "2024", None, None, 6),
        ],
        LOG,
    )
    assert rows(L.reduced_labels(log), "paper_id", "category", "is_core") == [("a", "out_of_scope", False), ("b", "x", False), ("c", "first", False)]
    assert rows(L.last_labels(log.where("paper_id is not null"))) == [("a", "out_of_scope"), ("b", "y"), ("c", "second")]
    assert L.tier_floor("Sonnet") == 3 and L.tier_floor(None) == -1
    with pytest.raises(ValueError):
        L.tier_floor("nobody")
    with pytest.raises(ValueError):
        L.papers_in_category(log, "nonsense")


def test_layers(spark):
    legacy = spark.createDataFrame([("a", "tda_brain", 0), ("a", "fmri_gnn", 1), ("b", "spectral_brain", 2), ("e", "odd", 3)], "paper_id string, category string, ord long")
    binary = spark.createDataFrame([("b", True, 0), ("b", False, 1), ("c", False, 2), ("d", True, 3)], "paper_id string, is_positive boolean, ord long")
    log = spark.createDataFrame([("d", "fmri_no_graph", 0)], "paper_id string, category string, ord long")
    assert rows(L.layered_labels(legacy, binary, log)) == [("a", "fmri_gnn"), ("b", "fmri_gnn"), ("c", "out_of_scope"), ("d", "fmri_no_graph"), ("e", "out_of_scope")]


def test_aliases(spark):
    chain = [(f"n{k}", f"n{k + 1}", k) for k in range(20)] + [("x", "y", 30), ("y", "x", 31), ("s", "s", 32), ("old", "n19", 33), ("old", "x", 34)]
    found = dict(rows(L.resolve_aliases(spark.createDataFrame(chain, "alias string, canonical string, ord long"))))

    def walk(p):
        names = {a: c for a, c, _ in chain}
        for _ in range(16):
            if p not in names:
                break
            p = names[p]
        return p

    assert found == {a: walk(a) for a, _, _ in chain}


def test_batches_are_numbered_without_one_big_sort(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000)
    found = L.numbered_batches(df, [F.col("k")], 30).collect()
    assert sorted((r.place, r.k, r.batch) for r in found) == [(k, k, k // 30) for k in range(1000)]


def test_merges(spark):
    a = spark.createDataFrame([("p", "", 0, 0), ("p", "late", 5, 1), ("q", None, None, 2)], "paper_id string, title string, year int, ord long")
    b = spark.createDataFrame([("p", "other", 7, 0), ("r", "only", None, 1)], "paper_id string, title string, year int, ord long")
    assert rows(P.fill_gaps([a, b])) == [("p", "late", 0), ("q", None, None), ("r", "only", None)]
    assert rows(P.overlaid(a, b)) == [("p", "other", 7), ("q", None, None), ("r", "only", None)]


def test_quality_report(spark):
    papers = spark.createDataFrame(
        [("a", "t", 1, "v", "s", "f", 0), ("a", "t", 2000, "v", "s", "f", 1), ("b", " ", 0, None, None, None, 2)], "paper_id string, title string, year int, venue string, source string, fetched_at string, ord long"
    )
    edges = spark.createDataFrame([("a", "b"), ("a", "z"), (None, "a"), ("a", "b")], "src string, dst string")
    assert rows(P.quality_report(papers, edges)) == [(1, 1, 1, 2)]


def test_components_and_networks(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("s", "s"), (None, "a"), ("c", "c")], "src string, dst string")
    assert rows(graph.connected_components(edges)) == [("a", "a"), ("b", "a"), ("c", "a"), ("s", "s"), ("x", "x"), ("y", "x")]
    path = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in graph.connected_components(path).collect()} == {0}
    members = spark.createDataFrame([("a",), ("x",), ("lone",)], "paper_id string")
    with_order = edges.withColumn("ord", F.lit(0))
    kept = C.network_edges(with_order, members)
    assert rows(kept, "src", "dst") == [("a", "b"), ("x", "y"), ("y", "x")]
    nodes = C.network_nodes(members.where("paper_id = 'a'"), members.where("paper_id <> 'a'"), C.boundary_nodes(kept))
    assert rows(nodes) == [("a", "core"), ("b", "boundary"), ("lone", "secondary"), ("x", "secondary"), ("y", "boundary")]
    stats = C.network_stats(nodes, kept).first()
    assert (stats.n_nodes, stats.n_edges, stats.components, stats.largest, stats.isolated, stats.density) == (5, 3, 3, 2, 1, 0.3)
    inside, loops = C.induced_edges(edges, spark.createDataFrame([("a",), ("b",), ("s",)], "paper_id string"))
    assert rows(inside) == [("a", "b")] and loops.first().self_loops == 1


def test_neighbours(spark):
    edges = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "x"), ("q", "y"), ("q", "z"), ("q", "y")], "src string, dst string")
    assert rows(C.co_cited_with(edges, "x")) == [("y", 2)]
    assert rows(C.cites(edges, "q")) == [("x",), ("y",), ("z",)] and rows(C.cited_by(edges, "y")) == [("p",), ("q",)]
    cycle = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "paper_id string")
    assert rows(C.expand(cycle, seeds, depth=5, limit=9)) == [("a", 0), ("b", 1), ("c", 2)]
    assert rows(C.expand(cycle, seeds, depth=5, limit=1)) == [("a", 0), ("b", 1)]
    links = spark.createDataFrame([("n", f"c{k}") for k in range(6)] + [("m", "c1"), ("c2", "m"), ("l", "c1")], "src string, dst string")
    core = spark.createDataFrame([(f"c{k}",) for k in range(6)], "paper_id string")
    assert rows(C.core_connections(links, core)) == [("l", 1, 0), ("m", 2, 1), ("n", 6, 2)]


def test_communities(spark):
    clique = lambda names: [(a, b) for a in names for b in names if a < b]
    edges = clique("abcde") + clique("vwxyz") + [("e", "v")] + clique("mn")
    found = {r.node: (r.component, r.community) for r in M.communities(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert {n for n, g in found.items() if g == found["a"]} == set("abcde")
    assert {n for n, g in found.items() if g == found["z"]} == set("vwxyz")
    assert found["m"][0] == "m"
    papers = spark.createDataFrame([("a", "Graph brains again", "V"), ("b", "graph other", "V"), ("c", None, "U")], "paper_id string, title string, venue string")
    groups = spark.createDataFrame([(n, *g) for n, g in found.items()], "node string, component string, community int")
    best = {(r.component, r.community): r for r in M.community_summary(groups, papers).collect()}[found["a"]]
    assert best["size"] == 5 and best.top_venues == ["V", "U"] and best.top_keywords[0] == "graph"


def modularity(edges, found):
    pairs = {tuple(sorted(e)) for e in edges if e[0] != e[1]}
    degree, inside = {}, 0
    for a, b in pairs:
        inside += found[a] == found[b]
        for n in (a, b):
            degree[found[n]] = degree.get(found[n], 0) + 1
    return inside / len(pairs) - sum((d / (2 * len(pairs))) ** 2 for d in degree.values())


def test_communities_of_a_large_component(spark):
    """A component above the size of one task's work is split too, about as well as pair by pair."""
    r = random.Random(3)
    edges = [(f"g{g}n{a}", f"g{g}n{b}") for g in range(12) for a in range(20) for b in r.sample(range(20), 5)]
    edges += [(f"g{g}n{r.randrange(20)}", f"g{(g + 1) % 12}n{r.randrange(20)}") for g in range(12) for _ in range(3)]
    edges += [("hub", f"leaf{k}") for k in range(200)] + [("hub", "g0n0"), ("small", "pair")]
    found = {x.node: (x.component, x.community) for x in M.communities(spark.createDataFrame(edges, "src string, dst string"), 50).collect()}
    assert set(found) == {n for e in edges for n in e} and len({c for c, _ in found.values()}) == 2
    exact = M.greedy_communities([e for e in edges if e[0] != "small"])
    large = [e for e in edges if e[0] != "small"]
    assert modularity(large, found) > 0.95 * modularity(large, exact) > 0.5
    sizes = [sum(g == (found["hub"][0], k) for g in found.values()) for k in range(len(set(found.values())) - 1)]
    assert sizes == sorted(sizes, reverse=True) and min(sizes) > 0


def test_titles(spark):
    papers = spark.createDataFrame([("a", "Brain connectivity graphs", 2020, ["Jane Doe"]), ("b", "Brain connectivity", 2021, ["X Roe"]), ("c", "the of", 2020, []), ("d", None, 2020, [])], "paper_id string, title string, year int, authors array<string>")
    titles = S.tokenized(papers)
    assert rows(S.search_titles(titles, "brain connectivity")) == [("a", 0.8333), ("b", 1.0)]
    assert rows(S.resolve_by_title(titles, "Brain Connectivity!")) == [("b", 1.0)]
    assert rows(S.resolve_by_title(titles, "Brain Connectivity", year=2020, min_score=0.6, authors=["J. Doe"])) == [("a", 2 / 3 + 0.02)]
    assert rows(S.search_titles(titles, "the of")) == []
    with pytest.raises(ValueError):
        S.search_titles(titles, " ")


def test_ids(spark):
    ids = spark.createDataFrame([("doi", "10.48550/arxiv.2001.00001", "A"), ("pubmed", "7", "B"), ("s2", "7", "C"), ("pmc", "PMC5", "D"), ("s2hash", "a" * 40, "E")], "kind string, value string, canonical string")
    raw = ["arXiv:2001.00001", "2001.00001", "7", "pmid:7", "pmc5", "PMCID:PMC5", "s2:" + "A" * 40, "a" * 40, "W12", "what", " doi:10.48550/ARXIV.2001.00001 "]
    found = {r.raw: (r.kind, r.canonical) for r in P.resolved_ids(spark.createDataFrame([(x,) for x in raw], "raw string"), ids).collect()}
    assert found == {
        "arXiv:2001.00001": ("arxiv", "A"), "2001.00001": ("arxiv", "A"), "7": ("digits", "C"), "pmid:7": ("pubmed", "B"), "pmc5": ("pmc", "D"), "PMCID:PMC5": ("pmc", "D"),
        "s2:" + "A" * 40: ("s2", "E"), "a" * 40: ("s2hash", "E"), "W12": ("openalex", None), "what": (None, None), " doi:10.48550/ARXIV.2001.00001 ": ("doi", "A"),
    }


def test_corpus(spark):
    index = spark.createDataFrame(
        [("doi:1", "Fulltext/a.md", "t", True, 5, 0), ("s2:1", "fulltext/a.md", "t", True, 9, 1), ("DOI:1", "fulltext/b.md", None, False, 5, 2), ("x", "none.md", "t", True, 1, 3)],
        "paper_id string, fulltext_file string, title string, has_metadata boolean, n_chars int, ord long",
    )
    files = spark.createDataFrame([("fulltext/a.md",), ("fulltext/b.md",)], "path string")
    assert rows(R.yearly_selection(index, files), "paper_id", "path") == [("DOI:1", "fulltext/b.md")]
    docs = spark.createDataFrame([(1, "ab\r\nc d\n"), (2, ""), (3, "x\n\n")], "document_id long, text string")
    assert rows(R.read_lines(docs)) == [(1, 1, "ab"), (1, 2, "c"), (1, 3, "d"), (3, 1, "x"), (3, 2, "")]
    assert rows(R.read_lines(docs, 2, 2)) == [(1, 2, "c"), (3, 2, "")]


def test_layouts(spark):
    papers = spark.createDataFrame([("a", "fmri_gnn", 2010, 5, 3), ("b", "fmri_gnn", 2010, 0, 9), ("c", "other", None, 100, 0)], "paper_id string, category string, year int, citation_count int, degree int")
    assert G.timeline(papers).count() == G.atlas(papers).count() == G.impact(papers).count() == 3
    assert {r.paper_id: round(r["size"], 3) for r in G.node_sizes(papers).collect()}["b"] == 14.0
    top = {r.paper_id: (r.x, r.y) for r in G.atlas(papers).collect()}
    assert top["b"] == (610.0, 350.0)


def test_catalog(spark):
    papers = spark.createDataFrame([("a", "B", 2020, "x"), ("b", "a", 2020, "y"), ("c", "z", None, "x")], "paper_id string, title string, year int, category string")
    assert [r.paper_id for r in K.page(papers, 1).collect()] == ["b", "a", "c"]
    assert rows(K.year_pivot(papers, ["x", "y"])) == [(2020, 2, 1, 1), (None, 1, 1, 0)]
    line = spark.range(1).select(K.paper_line(F.lit("T?"), F.lit(None).cast("string"), F.array().cast("array<string>"))).first()[0]
    assert line == "- T? Source link pending"


def test_components_of_long_paths_and_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df, real=graph.cut_lineage: written.append(df.schema.simpleString()) or real(df))
    path = spark.range(2000).selectExpr("concat('p', id) as src", "concat('p', id + 1) as dst")
    star = spark.range(500).selectExpr("concat('s', id) as src", "'s' as dst")
    found = {r["node"]: r["component"] for r in graph.connected_components(path.union(star)).collect()}
    assert found == {f"p{k}": "p0" for k in range(2001)} | {f"s{k}": "s" for k in range(500)} | {"s": "s"}
    # rounds work on numbers: of the tables that are written, only the first and the last hold names
    assert sum("string" in kinds for kinds in written) == 2 and len(written) < 45


def test_insert_new_takes_each_key_that_is_there_once(spark):
    from citeloom.sources import writers

    seen = spark.createDataFrame([(k % 3,) for k in range(30)] + [(None,)], "k int")
    found = writers.insert_new(spark.createDataFrame([(1, "a"), (5, "c"), (5, "b"), (None, "n")], "k int, v string"), seen, ["k"], F.col("v"))
    assert sorted(map(tuple, found.collect()), key=str) == [(5, "b"), (None, "n")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
