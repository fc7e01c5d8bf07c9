"""Citation edges (src cites dst): neighbours, degrees, co-citation, induced and bounded graphs, expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import component_roots, cut_lineage


#: Edges of which a task finds the distinct ones.
EDGES_A_TASK = 250_000


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Each (src, dst) once. Tasks are as many as the edges need, so that the memory of one doesn't grow with the table: a
    distinct() alone holds all edges of a file's split, and then of a merged partition."""
    tasks = max(1, -(-edges.count() // EDGES_A_TASK))
    return edges.select("src", "dst").repartition(tasks, "src", "dst").distinct()


def clean_edges(edges: DataFrame, *, loops: bool = False) -> DataFrame:
    """Distinct edges with both ends; self-loops only if asked for."""
    kept = edges.where("src is not null and dst is not null")
    return distinct_edges(kept if loops else kept.where("src <> dst"))


def cites(edges: DataFrame, node) -> DataFrame:
    return edges.where(F.col("src") == node).select(F.col("dst").alias("paper_id")).distinct()


def cited_by(edges: DataFrame, node) -> DataFrame:
    return edges.where(F.col("dst") == node).select(F.col("src").alias("paper_id")).distinct()


def neighbours(edges: DataFrame, node) -> DataFrame:
    """(paper_id, cites, cited_by): the other ends of a paper's edges, and whether it cites them, is cited by them, or both."""
    near = edges.where(((F.col("src") == node) | (F.col("dst") == node)) & (F.col("src") != F.col("dst")))
    out = F.col("src") == node
    ends = near.select(F.when(out, F.col("dst")).otherwise(F.col("src")).alias("paper_id"), out.alias("out"))
    return ends.groupBy("paper_id").agg(F.bool_or("out").alias("cites"), F.bool_or(~F.col("out")).alias("cited_by"))


def co_cited_with(edges: DataFrame, node, *, top_k: int = 20, min_overlap: int = 2) -> DataFrame:
    """Papers that are cited together with one, by how many citing papers; the edges of its citers are all that is joined."""
    citers = edges.where(F.col("dst") == node).select("src").distinct()
    beside = edges.join(citers, "src", "left_semi").where(F.col("dst") != node)
    counts = beside.groupBy(F.col("dst").alias("paper_id")).agg(F.countDistinct("src").alias("n")).where(F.col("n") >= min_overlap)
    return counts.orderBy(F.desc("n"), "paper_id").limit(top_k)


def degrees(edges: DataFrame) -> DataFrame:
    """(paper_id, in_degree, out_degree, degree) of every end of distinct edges, in one aggregate."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("x"))
    sums = ends.groupBy(F.col("x.id").alias("paper_id")).agg(F.sum("x.i").alias("in_degree"), F.sum("x.o").alias("out_degree"))
    return sums.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def duplicate_edges(edges: DataFrame) -> DataFrame:
    """One row: edges, distinct ones, and how many repeat others."""
    distinct = F.countDistinct("src", "dst")
    return edges.agg(F.count("*").alias("n_rows"), distinct.alias("n_edges"), (F.count("*") - distinct).alias("duplicates"))


def node_stats(edges: DataFrame, labels: DataFrame, nodes: DataFrame, clusters: DataFrame | None = None, confirmed: DataFrame | None = None) -> DataFrame:
    """Degrees, label and node data of everything known, with cluster_id and is_confirmed if those are given; core follows the label."""
    joined = degrees(edges).join(labels.select("paper_id", "category", "is_core"), "paper_id", "full").join(nodes, "paper_id", "full")
    if clusters is not None:
        joined = joined.join(clusters.select("paper_id", "cluster_id"), "paper_id", "left")
    if confirmed is not None:
        joined = joined.join(confirmed.select("paper_id", F.lit(True).alias("is_confirmed")), "paper_id", "left").na.fill(False, ["is_confirmed"])
    return joined.na.fill(0, ["in_degree", "out_degree", "degree"]).na.fill(False, ["is_core"])


def induced_edges(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct edges between nodes without self-loops, and one row with the number of self-loops removed."""
    ids = nodes.select("paper_id")
    inside = edges.join(ids.withColumnRenamed("paper_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("paper_id", "dst"), "dst", "left_semi")
    return inside.where("src <> dst").select("src", "dst").distinct(), inside.agg(F.count_if(F.col("src") == F.col("dst")).alias("self_loops"))


def isolates(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("paper_id"))
    return nodes.select("paper_id").join(ends, "paper_id", "left_anti")


def network_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct edges with an end among `members` (self-loops stay), with src_in and dst_in; of repeated ones the first row's
    further columns, such as relation and source, stay. Edges outside go before the others are grouped."""
    ids = members.select("paper_id").distinct()
    more = [c for c in edges.columns if c not in ("src", "dst", "ord")]
    first = [F.min_by(c, "ord").alias(c) for c in more]
    ends = edges.where("src is not null and dst is not null")
    ends = ends.join(ids.select(F.col("paper_id").alias("src"), F.lit(True).alias("src_in")), "src", "left")
    ends = ends.join(ids.select(F.col("paper_id").alias("dst"), F.lit(True).alias("dst_in")), "dst", "left")
    kept = ends.na.fill(False, ["src_in", "dst_in"]).where("src_in or dst_in")
    kept = kept.groupBy("src", "dst", "src_in", "dst_in").agg(F.min("ord").alias("ord"), *first)
    return kept.select("dst", "src", "ord", *more, "src_in", "dst_in")


def boundary_nodes(edges: DataFrame) -> DataFrame:
    """Ends outside the network of edges from network_edges()."""
    ends = edges.select(F.explode(F.array(F.when(~F.col("src_in"), F.col("src")), F.when(~F.col("dst_in"), F.col("dst")))).alias("paper_id"))
    return ends.where("paper_id is not null").distinct()


def network_nodes(core: DataFrame, secondary: DataFrame, boundary: DataFrame) -> DataFrame:
    """(paper_id, node_type); core before secondary before boundary."""
    ranked = (
        core.select("paper_id", F.lit(0).alias("r")).unionByName(secondary.select("paper_id", F.lit(1).alias("r"))).unionByName(boundary.select("paper_id", F.lit(2).alias("r")))
    )
    kinds = F.array(F.lit("core"), F.lit("secondary"), F.lit("boundary"))
    return ranked.groupBy("paper_id").agg(F.min("r").alias("r")).select("paper_id", F.get(kinds, F.col("r")).alias("node_type"))


def component_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: components, the largest, and isolated nodes."""
    parts = component_roots(edges)
    whole = nodes.select("paper_id").join(parts.withColumnRenamed("node", "paper_id"), "paper_id", "left")
    # nodes without edges are components by their names
    sizes = whole.groupBy("root", F.when(F.col("root").isNull(), F.col("paper_id")).alias("alone")).agg(F.count("*").alias("size"))
    return sizes.agg(F.count("*").alias("components"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"), F.count_if(F.col("size") == 1).alias("isolated"))


def network_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes by type, edges, density by the undirected formula, and components. Nodes are written, as they are read twice."""
    nodes = cut_lineage(nodes)
    kinds = nodes.agg(
        F.count("*").alias("n_nodes"), *[F.count_if(F.col("node_type") == k).alias(k) for k in ("core", "secondary", "boundary")]
    )
    counts = kinds.crossJoin(edges.agg(F.count("*").alias("n_edges"))).crossJoin(component_stats(nodes, edges))  # one row each
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1)
    return counts.withColumn("density", F.round(F.when(pairs > 0, 2.0 * F.col("n_edges") / pairs).otherwise(0.0), 8))


def stats_file(stats: dict, categories: dict[str, int], built_at: str) -> dict:
    """What the statistics' file of a network holds, of a row of network_stats() and counts by category."""
    return {
        "nodes": {"total": stats["n_nodes"], **{k: stats[k] for k in ("core", "secondary", "boundary")}},
        "edges": {"total": stats["n_edges"], "deduplicated": True},
        "components": {"total": stats["components"], "largest": stats["largest"], "isolated": stats["isolated"]},
        "density": stats["density"],
        "category_distribution": categories,
        "built_at": built_at,
    }


def category_distribution(nodes: DataFrame, labels: DataFrame, default: str) -> DataFrame:
    """(node_type, category, n) of a network's nodes; nodes without a label have the default one."""
    joined = nodes.join(labels.select("paper_id", "category"), "paper_id", "left").na.fill(default, ["category"])
    return joined.groupBy("node_type", "category").agg(F.count("*").alias("n"))


def network_records(nodes: DataFrame, labels: DataFrame, papers: DataFrame, default: str) -> DataFrame:
    """One record a node: its type, its label or the default one, and its metadata, if any."""
    joined = nodes.join(labels.select("paper_id", "category"), "paper_id", "left").na.fill(default, ["category"])
    return joined.join(papers.drop("category"), "paper_id", "left")


def core_connections(edges: DataFrame, core: DataFrame) -> DataFrame:
    """(paper_id, links, stage): distinct core neighbours in either direction of papers that aren't core."""
    both = edges.select("src", "dst").union(edges.select("dst", "src")).toDF("paper_id", "core_id")
    near = both.join(core.select(F.col("paper_id").alias("core_id")), "core_id", "left_semi").join(core, "paper_id", "left_anti")
    counts = near.groupBy("paper_id").agg(F.countDistinct("core_id").alias("links"))
    return counts.withColumn("stage", F.when(F.col("links") >= 6, 2).when(F.col("links") >= 2, 1).otherwise(0))


def expand(edges: DataFrame, seeds: DataFrame, *, depth: int, limit: int, direction: str = "backward") -> DataFrame:
    """(paper_id, depth) reached from seeds by at most `depth` steps, each paper giving its first `limit` neighbours by id.

    Every step joins the frontier with the edges and takes away what was seen; steps are checkpointed.
    """
    near, far = ("src", "dst") if direction == "backward" else ("dst", "src")
    first = Window.partitionBy(near).orderBy(far)
    ranked = edges.select(near, far).distinct()
    seen = cut_lineage(seeds.select("paper_id").distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for step in range(1, depth + 1):
        out = ranked.join(frontier.select(F.col("paper_id").alias(near)), near, "left_semi")
        out = out.withColumn("r", F.row_number().over(first)).where(F.col("r") <= limit).select(F.col(far).alias("paper_id")).distinct()
        frontier = cut_lineage(out.join(seen, "paper_id", "left_anti").withColumn("depth", F.lit(step)))
        if frontier.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(frontier))
    return seen


def one_hop(edges: DataFrame, seeds: DataFrame, references: int, citers: int) -> DataFrame:
    """(src, dst, relation): what seeds cite and what cites them, the first of each by id."""
    ids = seeds.select("paper_id").distinct()
    refs = edges.join(ids.withColumnRenamed("paper_id", "src"), "src", "left_semi").withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).where(F.col("r") <= references)
    cits = edges.join(ids.withColumnRenamed("paper_id", "dst"), "dst", "left_semi").withColumn("r", F.row_number().over(Window.partitionBy("dst").orderBy("src"))).where(F.col("r") <= citers)
    both = refs.select("src", "dst", F.lit("references").alias("relation")).unionByName(cits.select("src", "dst", F.lit("citations").alias("relation")))
    return both.groupBy("src", "dst").agg(F.array_sort(F.collect_set("relation")).alias("relations"))
