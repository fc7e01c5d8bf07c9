"""The public citation graph: the edges among catalogued papers, with what describes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import fixed, text

from .citations import induced_edges, isolates
from .graph import connected_components, cut_lineage


def released_nodes(papers: DataFrame) -> DataFrame:
    """The columns of a release of the papers of core categories, each id once. Identifiers also come from the id itself."""
    given = lambda c: F.col(c) if c in papers.columns else F.lit(None).cast("string")
    made = {c: text.external_id(given(c), F.col("paper_id"), c) for c in ("doi", "arxiv", "pubmed", "pmc")}
    columns = [made.get(c, given(c)).alias(c) for c in fixed.RELEASE_COLUMNS]
    return papers.where(F.col("category").isin(*fixed.CORE_CATEGORIES)).select(*columns).dropDuplicates(["paper_id"])


def component_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(component, size) of all nodes, the largest first; a node without an edge is a component."""
    parts = connected_components(edges)
    whole = nodes.select("paper_id").join(parts.withColumnRenamed("node", "paper_id"), "paper_id", "left")
    return whole.groupBy(F.coalesce("component", "paper_id").alias("component")).agg(F.count("*").alias("size")).orderBy(F.desc("size"), "component")


def release_stats(nodes: DataFrame, edges: DataFrame, self_loops: DataFrame) -> DataFrame:
    """One row: nodes, edges, nodes with and without an edge, self-loops removed, nodes by category, components."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("paper_id")).distinct()
    counts = nodes.agg(F.count("*").alias("nodes"), *[F.count_if(F.col("category") == c).alias(c) for c in fixed.CORE_CATEGORIES])
    sizes = component_sizes(nodes, edges).agg(F.count("*").alias("components"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"), F.count_if(F.col("size") == 1).alias("isolated_components"))
    row = counts.crossJoin(edges.agg(F.count("*").alias("edges"))).crossJoin(ends.agg(F.count("*").alias("nodes_with_internal_edge")))  # one row each
    row = row.crossJoin(isolates(nodes, edges).agg(F.count("*").alias("isolated_nodes"))).crossJoin(sizes)
    return row.crossJoin(self_loops.select(F.col("self_loops").alias("self_loops_removed")))


def public_graph(papers: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, stats) of the graph that the catalogued papers induce."""
    nodes = cut_lineage(released_nodes(papers))
    inside, loops = induced_edges(edges, nodes)
    inside = cut_lineage(inside)
    return nodes, inside, release_stats(nodes, inside, loops)
