"""Citation-graph queries. `lineitem` holds the edges: orders (o...) cite parts (p...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators import citations as C
from citeloom.operators import communities as M
from citeloom.operators import forces as W
from citeloom.operators import layout as G
from citeloom.operators import graph
from citeloom.operators import idsets as S
from citeloom.operators import labels as L

from .registry import query, table


def edges_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))


def parts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as papers: name, brand as venue, size as year, type as category, price as citations."""
    lane = F.pmod(F.col("p_partkey"), F.lit(4))
    named = F.get(F.array(F.lit("fmri_gnn"), F.lit("fmri_geometric_manifold"), F.lit("fmri_graph_classical"), F.lit("other")), lane.cast("int"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("paper_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("venue"),
        (F.col("p_size") + 1985).alias("year"),
        named.alias("category"),
        F.floor("p_retailprice").cast("int").alias("citation_count"),
    )


_E = "e AS (SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem), d AS (SELECT DISTINCT src, dst FROM e)"
_P = """p AS (SELECT 'p' || p_partkey AS paper_id, p_name AS title, p_brand AS venue, p_size + 1985 AS year,
  ['fmri_gnn', 'fmri_geometric_manifold', 'fmri_graph_classical', 'other'][p_partkey % 4 + 1] AS category, CAST(floor(p_retailprice) AS INT) AS citation_count FROM part)"""
_DEGREE = "g AS (SELECT id, count(*) FILTER (i) AS in_degree, count(*) FILTER (NOT i) AS out_degree FROM (SELECT src AS id, false AS i FROM d UNION ALL SELECT dst, true FROM d) GROUP BY 1)"
_HASH = "(CAST('0x' || substr(sha1(paper_id), {at}, 4) AS INT) / 65535.0::DOUBLE - 0.5)"
_X = "-960.0::DOUBLE + ((greatest(2002, least(year, 2026)) - 2002) / 24.0::DOUBLE) * 1920"


@query(f"WITH {_E} SELECT dst AS paper_id FROM d WHERE src = 'o1'")
def cites(spark, sf_dir):
    return C.cites(edges_of(spark, sf_dir), "o1")


@query(f"WITH {_E} SELECT src AS paper_id FROM d WHERE dst = 'p1'")
def cited_by(spark, sf_dir):
    return C.cited_by(edges_of(spark, sf_dir), "p1")


@query("WITH e AS (SELECT 'p' || l_partkey AS src, 'p' || l_suppkey AS dst FROM lineitem WHERE l_partkey <> l_suppkey) SELECT paper_id, bool_or(o) AS cites, bool_or(NOT o) AS cited_by FROM (SELECT dst AS paper_id, true AS o FROM e WHERE src = 'p7' UNION ALL SELECT src, false FROM e WHERE dst = 'p7') GROUP BY 1")
def neighbours(spark, sf_dir):
    """What part 7 cites and what cites it, where parts cite the parts with the numbers of their suppliers."""
    lines = table(spark, sf_dir, "lineitem")
    edges = lines.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("p"), "l_suppkey").alias("dst"))
    return C.neighbours(edges, "p7")


@query(f"WITH {_E}, {_DEGREE} SELECT id AS paper_id, in_degree, out_degree, in_degree + out_degree AS degree FROM g")
def degrees(spark, sf_dir):
    return C.degrees(C.clean_edges(edges_of(spark, sf_dir)))


@query(f"WITH {_E} SELECT b.dst AS paper_id, count(DISTINCT b.src) AS n FROM d a JOIN d b USING (src) WHERE a.dst = 'p1' AND b.dst <> 'p1' GROUP BY 1 HAVING n >= 1 ORDER BY n DESC, 1 LIMIT 20")
def co_cited_with(spark, sf_dir):
    return C.co_cited_with(edges_of(spark, sf_dir), "p1", min_overlap=1)


@query(f"WITH {_E} SELECT src, dst FROM d WHERE dst IN (SELECT 'p' || p_partkey FROM part WHERE p_size > 20) AND src IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def induced_edges(spark, sf_dir):
    return C.induced_edges(edges_of(spark, sf_dir), _members(spark, sf_dir))[0]


@query("SELECT count(*) AS self_loops FROM lineitem WHERE l_partkey = l_suppkey")
def removed_self_loops(spark, sf_dir):
    """Parts that cite the part with the number of their supplier cite themselves at times."""
    lines = table(spark, sf_dir, "lineitem")
    edges = lines.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("p"), "l_suppkey").alias("dst"))
    return C.induced_edges(edges, parts_of(spark, sf_dir))[1]


def _members(spark, sf_dir):
    papers = table(spark, sf_dir, "part").where("p_size > 20").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"))
    return papers.union(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("o"), "o_orderkey")))


@query("SELECT 'o' || o_orderkey AS paper_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'p' || p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)")
def isolates(spark, sf_dir):
    nodes = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("paper_id")).union(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey")))
    return C.isolates(nodes, edges_of(spark, sf_dir))


def network(spark, sf_dir):
    """Parts of some sizes are core, orders of one priority secondary; the rest is boundary or out."""
    core = table(spark, sf_dir, "part").where("p_size > 45").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"))
    secondary = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("o"), "o_orderkey").alias("paper_id"))
    edges = C.network_edges(edges_of(spark, sf_dir), core.union(secondary))
    return core, secondary, edges


_NET = f"""{_E}, core AS (SELECT 'p' || p_partkey AS id FROM part WHERE p_size > 45), sec AS (SELECT 'o' || o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'),
net AS (SELECT id FROM core UNION SELECT id FROM sec),
n AS (SELECT src, dst, src IN (SELECT id FROM net) AS s, dst IN (SELECT id FROM net) AS t FROM d),
k AS (SELECT * FROM n WHERE s OR t),
bound AS (SELECT src AS id FROM k WHERE NOT s UNION SELECT dst FROM k WHERE NOT t),
nodes AS (SELECT id, 'core' AS node_type FROM core UNION ALL SELECT id, 'secondary' FROM sec UNION ALL SELECT id, 'boundary' FROM bound)"""


@query(f"WITH {_NET} SELECT id AS paper_id FROM bound")
def boundary_nodes(spark, sf_dir):
    return C.boundary_nodes(network(spark, sf_dir)[2])


@query(f"WITH {_NET} SELECT node_type, count(*) AS n FROM nodes GROUP BY 1")
def network_nodes(spark, sf_dir):
    core, secondary, edges = network(spark, sf_dir)
    return C.network_nodes(core, secondary, C.boundary_nodes(edges)).groupBy("node_type").agg(F.count("*").alias("n"))


_CC = """
cc(id, comp) USING KEY (id) AS (SELECT id, id FROM ids UNION
  (SELECT b.a, min(r.comp) FROM both_ways b JOIN recurring.cc r ON b.b = r.id JOIN recurring.cc own ON own.id = b.a WHERE r.comp < own.comp GROUP BY 1))"""


@query(f"""
WITH RECURSIVE {_NET}, ids AS (SELECT id FROM nodes), both_ways AS (SELECT src AS a, dst AS b FROM k UNION ALL SELECT dst, src FROM k), {_CC},
sizes AS (SELECT comp, count(*) AS size FROM cc GROUP BY 1)
SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM core) AS core, (SELECT count(*) FROM sec) AS secondary, (SELECT count(*) FROM bound) AS boundary,
  (SELECT count(*) FROM k) AS n_edges, count(*) AS components, max(size) AS largest, count(*) FILTER (size = 1) AS isolated,
  round(2.0::DOUBLE * (SELECT count(*) FROM k) / ((SELECT count(*) FROM nodes) * ((SELECT count(*) FROM nodes) - 1)), 8) AS density FROM sizes""")
def network_stats(spark, sf_dir):
    core, secondary, edges = network(spark, sf_dir)
    edges = graph.cut_lineage(edges)
    return C.network_stats(C.network_nodes(core, secondary, C.boundary_nodes(edges)), edges)


@query(f"""
WITH RECURSIVE {_E}, ids AS (SELECT src AS id FROM d UNION SELECT dst FROM d), both_ways AS (SELECT src AS a, dst AS b FROM d UNION ALL SELECT dst, src FROM d), {_CC}
SELECT id AS node, comp AS component FROM cc""")
def connected_components(spark, sf_dir):
    return graph.connected_components(edges_of(spark, sf_dir))


@query(f"""
WITH {_E}, core AS (SELECT 'p' || p_partkey AS id FROM part WHERE p_type = 'STANDARD BRUSHED STEEL' OR p_size > 25),
x AS (SELECT src AS paper_id, count(DISTINCT dst) AS links FROM d WHERE dst IN (SELECT id FROM core) AND src NOT IN (SELECT id FROM core) GROUP BY 1)
SELECT paper_id, links, CASE WHEN links >= 6 THEN 2 WHEN links >= 2 THEN 1 ELSE 0 END AS stage FROM x""")
def core_connections(spark, sf_dir):
    core = table(spark, sf_dir, "part").where("p_type = 'STANDARD BRUSHED STEEL' or p_size > 25").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"))
    return C.core_connections(edges_of(spark, sf_dir), core)


@query("""
WITH near AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM (
    SELECT DISTINCT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem)) WHERE r <= 3),
s0 AS (SELECT 'o' || o_orderkey AS id FROM orders WHERE o_orderstatus = 'P'), s1 AS (SELECT DISTINCT dst AS id FROM near WHERE src IN (SELECT id FROM s0)), s2 AS (SELECT DISTINCT dst AS id FROM near WHERE src IN (SELECT id FROM s1))
SELECT id AS paper_id, 0 AS depth FROM s0 UNION ALL SELECT id, 1 FROM s1 UNION ALL SELECT id, 2 FROM s2""")
def bounded_expansion(spark, sf_dir):
    """Orders lead to parts and parts to suppliers, three of each, two steps deep."""
    lines = table(spark, sf_dir, "lineitem")
    edges = lines.select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    edges = edges.union(lines.select(F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey")))
    seeds = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("o"), "o_orderkey").alias("paper_id"))
    return C.expand(edges, seeds, depth=2, limit=3)


@query(f"""
WITH {_E}, seeds AS (SELECT 'o' || o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'p' || p_partkey FROM part WHERE p_size = 1)
SELECT src, dst, CASE WHEN bool_or(k = 'citations') AND bool_or(k = 'references') THEN 'citations,references' ELSE max(k) END AS relations FROM (
  SELECT src, dst, 'references' AS k FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM d) WHERE r <= 2 AND src IN (SELECT id FROM seeds)
  UNION ALL SELECT src, dst, 'citations' FROM (SELECT *, row_number() OVER (PARTITION BY dst ORDER BY src) AS r FROM d) WHERE r <= 2 AND dst IN (SELECT id FROM seeds)) GROUP BY 1, 2""")
def neighbourhood(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("o"), "o_orderkey").alias("paper_id"))
    seeds = orders.union(table(spark, sf_dir, "part").where("p_size = 1").select(F.concat(F.lit("p"), "p_partkey")))
    found = C.one_hop(C.clean_edges(edges_of(spark, sf_dir)), seeds, 2, 2)
    return found.select("src", "dst", F.array_join("relations", ",").alias("relations"))


@query("SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_partkey)) AS n_edges, count(*) - count(DISTINCT (l_orderkey, l_partkey)) AS duplicates FROM lineitem")
def duplicate_edges(spark, sf_dir):
    return C.duplicate_edges(edges_of(spark, sf_dir))


@query(f"""
WITH {_E}, {_P}, {_DEGREE} SELECT paper_id, category, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree, category LIKE 'fmri%' AS is_core, citation_count FROM p LEFT JOIN g ON id = paper_id
UNION ALL SELECT id, NULL, in_degree, out_degree, false, NULL FROM g WHERE id NOT IN (SELECT paper_id FROM p)""")
def node_stats(spark, sf_dir):
    papers = parts_of(spark, sf_dir)
    labels = papers.select("paper_id", "category", F.col("category").startswith("fmri").alias("is_core"))
    found = C.node_stats(C.clean_edges(edges_of(spark, sf_dir)), labels, papers.select("paper_id", "citation_count"))
    return found.select("paper_id", "category", "in_degree", "out_degree", "is_core", "citation_count")


@query(f"""
WITH {_P}, q AS (SELECT *, row_number() OVER (PARTITION BY category, year ORDER BY paper_id) - 1 AS rn, count(*) OVER (PARTITION BY category, year) AS n,
  CASE category WHEN 'fmri_gnn' THEN 620.0::DOUBLE WHEN 'fmri_graph_classical' THEN -620.0::DOUBLE ELSE 0.0::DOUBLE END AS mid FROM p)
SELECT paper_id, round({_X} + {_HASH.format(at=1)} * 48, 4) AS x, round(CASE WHEN n = 1 THEN mid ELSE mid - 235 + rn / (n - 1)::DOUBLE * 470 END + {_HASH.format(at=5)} * 7, 4) AS y FROM q""")
def timeline_layout(spark, sf_dir):
    return _rounded(G.timeline(parts_of(spark, sf_dir)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query(f"""
WITH {_E}, {_P}, {_DEGREE}, q AS (SELECT paper_id, row_number() OVER (PARTITION BY category ORDER BY coalesce(in_degree + out_degree, 0) DESC, paper_id) - 1 AS rn,
  CASE category WHEN 'fmri_graph_classical' THEN -430.0::DOUBLE WHEN 'fmri_gnn' THEN 610.0::DOUBLE WHEN 'fmri_geometric_manifold' THEN 620.0::DOUBLE ELSE 0.0::DOUBLE END AS x0,
  CASE category WHEN 'fmri_gnn' THEN 350.0::DOUBLE WHEN 'fmri_geometric_manifold' THEN -470.0::DOUBLE ELSE 0.0::DOUBLE END AS y0 FROM p LEFT JOIN g ON id = paper_id)
SELECT paper_id, round(x0 + 7.6::DOUBLE * sqrt(rn) * cos(rn * (pi() * (3 - sqrt(5)))), 4) AS x, round(y0 + 7.6::DOUBLE * sqrt(rn) * sin(rn * (pi() * (3 - sqrt(5)))), 4) AS y FROM q""")
def atlas_layout(spark, sf_dir):
    return _rounded(G.atlas(_with_degree(spark, sf_dir)))


def _with_degree(spark, sf_dir):
    found = C.degrees(C.clean_edges(edges_of(spark, sf_dir))).select("paper_id", "degree")
    return parts_of(spark, sf_dir).join(found, "paper_id", "left").na.fill(0, ["degree"])


@query(f"""
WITH {_P}, q AS (SELECT *, ln(1 + (SELECT max(citation_count) FROM p)) AS most FROM p)
SELECT paper_id, round({_X} + {_HASH.format(at=1)} * 42, 4) AS x, round(-690 + ln(1 + citation_count) / most * 1380 + {_HASH.format(at=5)} * 15, 4) AS y FROM q""")
def impact_layout(spark, sf_dir):
    return _rounded(G.impact(parts_of(spark, sf_dir)))


@query(f"""
WITH {_E}, {_P}, {_DEGREE}, q AS (SELECT paper_id, coalesce(in_degree + out_degree, 0) AS degree FROM p LEFT JOIN g ON id = paper_id),
r AS (SELECT paper_id, sqrt(ln(1 + degree) / (SELECT ln(1 + max(degree)) FROM q)) AS s FROM q)
SELECT paper_id, round(2 + 12 * s, 4) AS size, round(1.4::DOUBLE + 5.6::DOUBLE * s, 4) AS web_size FROM r""")
def node_sizes(spark, sf_dir):
    return _rounded(G.node_sizes(_with_degree(spark, sf_dir)))


@query("""
WITH RECURSIVE hop(alias, c, k) AS (SELECT o_orderkey, o_orderkey // 2, 1 FROM orders UNION ALL SELECT alias, c // 2, k + 1 FROM hop WHERE k < 16 AND c IN (SELECT o_orderkey FROM orders))
SELECT CAST(alias AS VARCHAR) AS alias, CAST(arg_max(c, k) AS VARCHAR) AS canonical FROM hop GROUP BY 1""")
def alias_closure(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    aliases = orders.select(F.col("o_orderkey").cast("string").alias("alias"), F.expr("cast(o_orderkey div 2 as string)").alias("canonical"), F.col("o_orderkey").alias("ord"))
    return L.resolve_aliases(aliases)


@query("""
WITH RECURSIVE hop(alias, c, k) AS (SELECT o_orderkey, o_orderkey // 2, 1 FROM orders UNION ALL SELECT alias, c // 2, k + 1 FROM hop WHERE k < 16 AND c IN (SELECT o_orderkey FROM orders)),
a AS (SELECT alias, arg_max(c, k) AS canonical FROM hop GROUP BY 1)
SELECT CAST(canonical AS VARCHAR) AS src, count(DISTINCT l_partkey) AS n FROM lineitem JOIN a ON alias = l_orderkey GROUP BY 1""")
def canonical_edges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("src"), F.col("l_partkey").alias("dst"))
    return L.canonicalized(lines, "src", alias_closure(spark, sf_dir)).groupBy("src").agg(F.countDistinct("dst").alias("n"))


@query()
def communities(spark, sf_dir):
    """All orders and parts, by the edges of every other graph query."""
    return M.communities(edges_of(spark, sf_dir))


@query("""
WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), n AS (SELECT s, p, s_nationkey AS c, p_size % 25 AS d FROM e JOIN supplier ON s_suppkey = s JOIN part ON p_partkey = p),
x AS (SELECT c, d FROM n UNION ALL SELECT d, c FROM n), m AS (SELECT count(*)::DOUBLE AS m FROM n)
SELECT c AS community, CAST(count(*) FILTER (c = d) // 2 AS BIGINT) AS inside, count(*) AS degree, round(count(*) FILTER (c = d) / 2 / any_value(m) - pow(count(*) / (2 * any_value(m)), 2), 9) AS share FROM x, m GROUP BY 1""")
def community_modularity(spark, sf_dir):
    """What each community adds to the modularity: suppliers by nation, and parts of 25 sizes, tied by line items."""
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    members = supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.col("s_nationkey").cast("int").alias("community")).unionByName(part.select(F.concat(F.lit("p"), "p_partkey").alias("node"), (F.col("p_size") % 25).cast("int").alias("community")))
    lines = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    return M.modularity(lines, members).select("community", "inside", "degree", F.round("share", 9).alias("share"))


@query("""
WITH p AS (SELECT p_partkey % 3 AS component, p_size % 5 AS community, p_brand AS venue, p_name AS title FROM part),
v AS (SELECT component, community, venue AS w, row_number() OVER (PARTITION BY component, community ORDER BY count(*) DESC, venue) AS r FROM p GROUP BY 1, 2, 3),
t AS (SELECT component, community, unnest(regexp_split_to_array(lower(title), '\\s+')) AS w FROM p),
k AS (SELECT component, community, w, row_number() OVER (PARTITION BY component, community ORDER BY count(*) DESC, w) AS r FROM t WHERE length(w) > 4 GROUP BY 1, 2, 3)
SELECT component, community, (SELECT count(*) FROM p WHERE p.component = a.component AND p.community = a.community) AS size,
  (SELECT string_agg(w, '|' ORDER BY r) FROM v WHERE v.component = a.component AND v.community = a.community AND r <= 3) AS top_venues,
  (SELECT string_agg(w, '|' ORDER BY r) FROM k WHERE k.component = a.component AND k.community = a.community AND r <= 5) AS top_keywords
FROM (SELECT DISTINCT component, community FROM p) AS a""")
def community_words(spark, sf_dir):
    """The commonest venues and title words of given communities: parts by key and size."""
    part = table(spark, sf_dir, "part")
    found = part.select(F.col("p_partkey").alias("node"), (F.col("p_partkey") % 3).alias("component"), (F.col("p_size") % 5).alias("community"))
    papers = part.select(F.col("p_partkey").alias("paper_id"), F.col("p_brand").alias("venue"), F.col("p_name").alias("title"))
    rows = M.community_summary(found, papers)
    return rows.select("component", "community", "size", F.concat_ws("|", "top_venues").alias("top_venues"), F.concat_ws("|", "top_keywords").alias("top_keywords"))


def _supply(spark, sf_dir):
    """Parts, suppliers and customers as papers; orders of a supplier's own nation's customers tie them, customers without are alone."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    nodes = supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("paper_id")).unionByName(part.select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"))).unionByName(table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("paper_id")))
    edges = table(spark, sf_dir, "lineitem").where("l_quantity >= 40").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    return nodes, edges


@query()
def network_layout(spark, sf_dir):
    """Positions by forces of all suppliers and parts that large orders tie, and of all others on the circle."""
    return W.force_layout(*_supply(spark, sf_dir), rounds=10)


@query("""
WITH n AS (SELECT 's' || s_suppkey AS paper_id FROM supplier UNION SELECT 'p' || p_partkey FROM part UNION SELECT 'c' || c_custkey FROM customer),
e AS (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem WHERE l_quantity >= 40),
t AS (SELECT src AS paper_id FROM e SEMI JOIN n ON n.paper_id = dst UNION SELECT dst FROM e SEMI JOIN n ON n.paper_id = src),
i AS (SELECT paper_id, row_number() OVER (ORDER BY paper_id) - 1 AS k, count(*) OVER () AS m FROM n ANTI JOIN t USING (paper_id))
SELECT paper_id, round(1050 * cos(2 * pi() * k / m), 6) + 0.0 AS x, round(1050 * sin(2 * pi() * k / m), 6) + 0.0 AS y FROM i""")
def isolate_circle(spark, sf_dir):
    """The nodes that no edge ties, on the circle of the layout."""
    nodes, edges = _supply(spark, sf_dir)
    # edges and their ends go once: they repeat each node many times
    tied = edges.distinct().join(nodes.select(F.col("paper_id").alias("dst")), "dst", "left_semi").join(nodes.select(F.col("paper_id").alias("src")), "src", "left_semi")
    alone = nodes.join(tied.select(F.explode(F.array("src", "dst")).alias("paper_id")).distinct(), "paper_id", "left_anti")
    return W.isolates(alone).select("paper_id", (F.round("x", 6) + 0.0).alias("x"), (F.round("y", 6) + 0.0).alias("y"))


@query("""
SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION SELECT user_id FROM events)
UNION ALL SELECT 'difference', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersection', count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT user_id FROM events)
UNION ALL SELECT 'bag', count(*) FROM (SELECT o_custkey FROM orders UNION ALL SELECT user_id FROM events)""")
def id_sets(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    b = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    every = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return S.sizes({"union": S.union(a, b), "difference": S.difference(every, a), "intersection": S.intersection(a, b), "bag": S.concatenated(a, b)})


@query(f"WITH {_P} SELECT paper_id, CASE WHEN length(title) > 10 THEN substr(title, 1, 10) || '...' ELSE title END AS label FROM p")
def short_labels(spark, sf_dir):
    return parts_of(spark, sf_dir).select("paper_id", text.short_label(F.col("title"), 10).alias("label"))
