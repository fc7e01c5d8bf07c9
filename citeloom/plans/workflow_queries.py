"""Queries of the workflow around the graph: catalog pages, release, neighbourhoods, expansion, backfill and seeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.functions import documents as D
from citeloom.functions import fixed, text
from citeloom.operators import backfill as B
from citeloom.operators import catalog as K
from citeloom.operators import citations as C
from citeloom.operators import expansion as X
from citeloom.operators import labels as L
from citeloom.operators import neighbourhood as N
from citeloom.operators import pages as G
from citeloom.operators import papers as P
from citeloom.operators import release as R

from .graph_queries import _CC, _NET, _P, edges_of, network, parts_of
from .registry import query, table

_HEADING = "CASE category " + " ".join(f"WHEN '{c}' THEN '{h}'" for c, h in fixed.CATEGORY_HEADINGS.items()) + " END"
_CATALOG = f"""{_P},
q AS (SELECT *, {_HEADING} AS heading, CAST(substr(paper_id, 2) AS INT) AS k FROM p WHERE category <> 'other'),
c AS (SELECT *, CASE k % 3 WHEN 0 THEN 'doi' WHEN 1 THEN 'pubmed-pmc' ELSE 'pending' END AS source,
  CASE k % 3 WHEN 0 THEN '[DOI](https://doi.org/10.1/' || k || ')' WHEN 1 THEN '[PubMed](https://pubmed.ncbi.nlm.nih.gov/' || k || '/)' ELSE 'Source link pending' END AS link FROM q)"""


def _catalog(spark, sf_dir):
    """Parts as papers with links: a DOI, a PubMed number, or none."""
    papers = parts_of(spark, sf_dir)
    number, none = F.substring("paper_id", 2, 20), F.lit(None).cast("string")
    kind = number.cast("int") % 3
    links = D.source_links(F.col("paper_id"), F.when(kind == 0, F.concat(F.lit("10.1/"), number)), none, none, F.when(kind == 1, number), none)
    return papers.withColumn("links", links).withColumn("shown_title", F.col("title")).withColumn("shown_venue", F.col("venue"))


@query(f"""WITH {_CATALOG},
v AS (SELECT 'c' AS view, category || '.md' AS page, CAST(year AS VARCHAR) AS section, * FROM c UNION ALL SELECT 'y', 'by_year/' || year || '.md', heading, * FROM c
  UNION ALL SELECT 'v', 'by_venue/b.md', venue, * FROM c UNION ALL SELECT 's', 'by_source/' || source || '.md', CAST(year AS VARCHAR), * FROM c),
g AS (SELECT view, page, section, any_value(heading) AS heading, any_value(year) AS year, any_value(source) AS source, count(*) AS n FROM v GROUP BY 1, 2, 3),
h AS (SELECT view, page, any_value(heading) AS heading, any_value(year) AS year, any_value(source) AS source, sum(n) AS n, count(*) AS parts FROM g GROUP BY 1, 2)
SELECT page, '- ' || title || CASE view WHEN 'v' THEN '' ELSE ' — ' || venue END || '. ' || link AS line FROM v
UNION ALL SELECT page, '## ' || section || CASE WHEN view IN ('y', 'v') THEN ' (' || format('{{:,}}', n) || ')' ELSE '' END FROM g
UNION ALL SELECT page, '# ' || CASE view WHEN 'c' THEN heading WHEN 'y' THEN CAST(year AS VARCHAR) WHEN 'v' THEN 'Publication venues: B' ELSE 'Source: ' || CASE source WHEN 'doi' THEN 'DOI' WHEN 'pubmed-pmc' THEN 'PubMed or PMC' ELSE 'Source link pending' END END FROM h
UNION ALL SELECT page, CASE view WHEN 'c' THEN '[Catalog](README.md)' ELSE '[Groups](README.md) · [Catalog](../README.md)' END FROM h
UNION ALL SELECT page, CASE view WHEN 'v' THEN parts || ' venues, ' ELSE '' END || format('{{:,}}', CAST(n AS BIGINT)) || ' papers' FROM h""")
def catalog_pages(spark, sf_dir):
    return G.page_lines(_catalog(spark, sf_dir)).select("page", "line")


@query(f"""WITH {_CATALOG}
SELECT 'README.md' AS page, '| [' || heading || '](' || category || '.md) | ' || format('{{:,}}', count(*)) || ' |' AS line FROM c GROUP BY category, heading
UNION ALL SELECT 'by_year/README.md', '| [' || year || '](' || year || '.md) | ' || format('{{:,}}', count(*)) || ' | ' || format('{{:,}}', count(*) FILTER (category = 'fmri_gnn')) || ' | ' || format('{{:,}}', count(*) FILTER (category = 'fmri_geometric_manifold')) || ' | ' || format('{{:,}}', count(*) FILTER (category = 'fmri_graph_classical')) || ' |' FROM c GROUP BY year
UNION ALL SELECT 'by_venue/README.md', '| [B](b.md) | ' || count(DISTINCT venue) || ' | ' || format('{{:,}}', count(*)) || ' |' FROM c
UNION ALL SELECT 'by_source/README.md', '| [' || name || '](' || page || '.md) | ' || format('{{:,}}', (SELECT count(*) FROM c WHERE source = page)) || ' |'
  FROM (VALUES ('DOI', 'doi'), ('arXiv', 'arxiv'), ('PubMed or PMC', 'pubmed-pmc'), ('Other stable source', 'other'), ('Source link pending', 'pending')) AS s(name, page)""")
def catalog_index(spark, sf_dir):
    lines = G.index_lines(_catalog(spark, sf_dir))
    return lines.where("place.part = 1").select("page", "line")


def _part_edges(spark, sf_dir):
    """Parts cite the parts with the numbers of their suppliers, at times themselves."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("p"), "l_suppkey").alias("dst"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))


_INSIDE = f"""{_P}, n AS (SELECT * FROM p WHERE category <> 'other'),
l AS (SELECT 'p' || l_partkey AS src, 'p' || l_suppkey AS dst, l_orderkey * 10 + l_linenumber AS ord FROM lineitem),
i AS (SELECT * FROM l WHERE src IN (SELECT paper_id FROM n) AND dst IN (SELECT paper_id FROM n)),
e AS (SELECT DISTINCT src, dst FROM i WHERE src <> dst),
ids AS (SELECT paper_id AS id FROM n), both_ways AS (SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e)"""


@query(f"""WITH RECURSIVE {_INSIDE}, {_CC}, s AS (SELECT comp, count(*) AS size FROM cc GROUP BY 1), t AS (SELECT DISTINCT a FROM both_ways)
SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM t) AS nodes_with_internal_edge, (SELECT count(*) FROM n) - (SELECT count(*) FROM t) AS isolated_nodes,
  (SELECT count(*) FROM i WHERE src = dst) AS self_loops_removed, (SELECT count(*) FROM n WHERE category = 'fmri_gnn') AS fmri_gnn, (SELECT count(*) FROM n WHERE category = 'fmri_graph_classical') AS fmri_graph_classical,
  (SELECT count(*) FROM n WHERE category = 'fmri_geometric_manifold') AS fmri_geometric_manifold, (SELECT count(*) FROM s) AS components, (SELECT max(size) FROM s) AS largest, (SELECT count(*) FROM s WHERE size = 1) AS isolated_components""")
def release_stats(spark, sf_dir):
    return R.public_graph(parts_of(spark, sf_dir), _part_edges(spark, sf_dir))[2]


@query(f"WITH {_INSIDE} SELECT src AS source, dst AS target, 'cites' AS relation FROM e")
def release_edges(spark, sf_dir):
    edges = R.public_graph(parts_of(spark, sf_dir), _part_edges(spark, sf_dir))[1]
    return edges.select(F.col("src").alias("source"), F.col("dst").alias("target"), F.lit("cites").alias("relation"))


@query(f"WITH {_INSIDE} SELECT paper_id, title, CAST(year AS INT) AS year, venue, category, '' AS doi, '' AS arxiv, '' AS pubmed, '' AS pmc, citation_count FROM n")
def release_nodes(spark, sf_dir):
    return R.released_nodes(parts_of(spark, sf_dir))


@query("SELECT min(least('s' || s_suppkey, 'n' || s_nationkey)) OVER (PARTITION BY s_nationkey) AS component, count(*) OVER (PARTITION BY s_nationkey) + 1 AS size FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey) = 1 UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def component_sizes(spark, sf_dir):
    """Suppliers and nations, by the nation of each supplier."""
    edges = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("src"), F.concat(F.lit("n"), "s_nationkey").alias("dst"))
    nodes = edges.select(F.col("src").alias("paper_id")).unionByName(table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("paper_id")))
    return R.component_sizes(nodes, edges)


# ------------------------------------------------------------------ neighbourhood
_SEEDS = 5


def _records(papers):
    """Parts as a service's records."""
    none = F.lit(None).cast("string")
    return papers.select(
        *[c for c in papers.columns if c in ("seed", "seen_in", "ord")],
        F.col("paper_id").alias("paperId"), none.alias("corpusId"), "title", "year", "venue", F.array(F.struct(F.col("venue").alias("name")), F.struct(F.lit("").alias("name"))).alias("authors"),
        F.create_map().cast("map<string,string>").alias("externalIds"), F.col("citation_count").alias("citationCount"), F.lit(0).alias("referenceCount"), F.concat(F.lit("https://a.org/"), "paper_id").alias("url"),
        F.struct(none.alias("url")).alias("openAccessPdf"), F.when(F.col("year") % 2 == 0, F.lit("text")).alias("abstract"), F.lit(None).cast("array<string>").alias("fieldsOfStudy"),
    )


def _met(spark, sf_dir):
    papers, edges = parts_of(spark, sf_dir), C.clean_edges(_part_edges(spark, sf_dir))
    seeds = papers.where(F.substring("paper_id", 2, 9).cast("int") <= _SEEDS).withColumn("seen_in", F.lit("query:parts")).withColumn("ord", F.lit(0).cast("long"))
    ids = seeds.select(F.col("paper_id").alias("seed"))
    number = lambda c: F.substring(c, 2, 20).cast("long")
    refs = edges.select(F.col("src").alias("seed"), F.col("dst").alias("paper_id")).join(ids, "seed").withColumn("ord", number("seed") * 1_000_000 + number("paper_id"))
    cits = edges.select(F.col("dst").alias("seed"), F.col("src").alias("paper_id")).join(ids, "seed").withColumn("ord", F.lit(10**12) + number("seed") * 1_000_000 + number("paper_id"))
    compact = lambda rows: N.compact(_records(rows.join(papers, "paper_id")))
    return N.neighbourhood(N.compact(_records(seeds)), compact(refs), compact(cits))


_MET = f"""{_P}, d AS (SELECT DISTINCT 'p' || l_partkey AS src, 'p' || l_suppkey AS dst FROM lineitem WHERE l_partkey <> l_suppkey),
s AS (SELECT paper_id FROM p WHERE CAST(substr(paper_id, 2) AS INT) <= {_SEEDS}),
r AS (SELECT src AS source, dst AS target, 'references' AS relation, dst AS other, src AS seed FROM d WHERE src IN (SELECT paper_id FROM s)
  UNION ALL SELECT src, dst, 'citations', src, dst FROM d WHERE dst IN (SELECT paper_id FROM s)),
m AS (SELECT paper_id, 'seed' AS role, 0 AS k, 0 AS spot, 'query:parts' AS seen FROM s
  UNION ALL SELECT other, CASE relation WHEN 'references' THEN 'reference' ELSE 'citation' END, CASE relation WHEN 'references' THEN 1 ELSE 2 END, CAST(substr(seed, 2) AS BIGINT) * 1000000 + CAST(substr(other, 2) AS BIGINT), 'seed:' || seed FROM r)"""


@query(f"""WITH {_MET}, o AS (SELECT paper_id, role, min(k) AS k FROM m GROUP BY 1, 2), w AS (SELECT paper_id, string_agg(role, ',' ORDER BY k) AS roles FROM o GROUP BY 1),
z AS (SELECT paper_id, string_agg(seen, ',' ORDER BY k, spot) AS seen_in FROM m GROUP BY 1)
SELECT paper_id, title, year % 2 = 0 AS abstract_available, venue AS authors, roles, seen_in FROM w JOIN z USING (paper_id) JOIN p USING (paper_id)""")
def neighbourhood_nodes(spark, sf_dir):
    nodes = _met(spark, sf_dir)[0]
    return nodes.select("paper_id", "title", "abstract_available", *[F.array_join(c, ",").alias(c) for c in ("authors", "roles", "seen_in")])


@query(f"WITH {_MET} SELECT source, target, relation FROM r")
def neighbourhood_edges(spark, sf_dir):
    return _met(spark, sf_dir)[1]


@query(f"WITH {_MET} SELECT paper_id, citation_count FROM r JOIN p ON paper_id = other WHERE relation = 'citations' ORDER BY citation_count DESC, year DESC, paper_id LIMIT 25")
def top_citing(spark, sf_dir):
    nodes, edges = _met(spark, sf_dir)
    return N.top_neighbours(nodes, edges, "citations").select("paper_id", "citation_count")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN CAST(doc_id AS VARCHAR) ELSE '2301.' || doc_id END AS number FROM documents")
def arxiv_numbers(spark, sf_dir):
    kind, doc = F.col("doc_id") % 3, F.col("doc_id").cast("string")
    given = F.when(kind == 0, F.concat(F.lit(" arXiv:2301."), doc)).when(kind == 1, F.concat(F.lit("arxiv:2301."), doc)).otherwise(doc)
    return table(spark, sf_dir, "documents").select("doc_id", text.arxiv_number(given).alias("number"))


# ------------------------------------------------------------------ expansion
_EXPAND = """
l AS (SELECT 'p' || l_partkey AS src, 'p' || l_suppkey AS dst, min(l_orderkey * 10 + l_linenumber) AS ord FROM lineitem GROUP BY 1, 2),
s AS (SELECT 'p' || p_partkey AS paper_id, p_partkey AS ord FROM part WHERE p_partkey BETWEEN 101 AND 160 AND p_partkey % 7 <> 0),
r AS (SELECT src, dst, s.ord AS place, row_number() OVER (PARTITION BY src ORDER BY l.ord, dst) AS rank FROM l JOIN s ON src = paper_id),
f AS (SELECT * FROM r WHERE rank <= 4 AND (src, dst) NOT IN (SELECT 'p' || l_partkey, 'p' || l_suppkey FROM lineitem WHERE l_linenumber = 1)),
t AS (SELECT * FROM f ORDER BY place, rank LIMIT 50)"""


def _expanded(spark, sf_dir):
    edges = _part_edges(spark, sf_dir)
    known = edges.join(table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select((F.col("l_orderkey") * 10 + 1).alias("ord")), "ord").select("src", "dst")
    number = F.substring("paper_id", 2, 20).cast("long")
    seeds = parts_of(spark, sf_dir).select("paper_id", number.alias("ord")).where("ord between 101 and 160")
    processed = seeds.where("ord % 7 = 0").select(F.concat(F.lit("backward:"), "paper_id", F.lit(":0")).alias("key"))
    return X.expand_limited(edges, seeds, known, processed, depth=1, per_paper=4, most=50)


@query(f"WITH {_EXPAND} SELECT src, dst FROM t")
def limited_expansion(spark, sf_dir):
    """The first 50 new edges of parts 101 to 160, four a part, in the order of the queue."""
    return _expanded(spark, sf_dir)[0]


@query(f"WITH {_EXPAND} SELECT 'backward:' || paper_id || ':0' AS key FROM s WHERE ord <= (SELECT CASE WHEN count(*) < 50 THEN 1000000 ELSE max(place) END FROM t)")
def expansion_keys(spark, sf_dir):
    return _expanded(spark, sf_dir)[1]


@query("SELECT DISTINCT user_id AS paper_id FROM events WHERE event_type IN ('click', 'view') OR event_id % 50 = 0 UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def evaluated_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "paper_id")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "paper_id")
    return X.evaluated_ids(events.where("event_type in ('click', 'view')"), events.where("event_id % 50 = 0"), orders)


@query("""WITH a AS (SELECT 's2:' || s_suppkey AS key, 'x' || s_nationkey AS canonical, 1 AS side, s_suppkey AS ord FROM supplier UNION ALL SELECT 'x' || s_nationkey, 'x' || s_nationkey, 1, s_suppkey FROM supplier
  UNION ALL SELECT 'mag:' || s_nationkey, 'x' || s_nationkey, 1, s_suppkey FROM supplier
  UNION ALL SELECT 'p' || p_partkey, 'p' || p_partkey, 0, p_partkey FROM part UNION ALL SELECT 'doi:10.1/' || p_size, 'p' || p_partkey, 0, p_partkey FROM part WHERE p_size % 2 = 0 UNION ALL SELECT 's2:' || p_partkey, 'p' || p_partkey, 0, p_partkey FROM part)
SELECT key, arg_max(canonical, side * 1000000000 + ord) AS canonical FROM a GROUP BY 1""")
def id_map(spark, sf_dir):
    """Parts name themselves by number and at times by a shared DOI; suppliers, as the kept map, override them."""
    number, none = F.col("p_partkey").cast("string"), F.lit(None).cast("string")
    papers = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), number).alias("paper_id"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://doi.org/10.1/"), F.col("p_size").cast("string"))).alias("doi"), number.alias("corpus_id"), none.alias("arxiv"), none.alias("pubmed"), F.col("p_partkey").alias("ord"))
    nation = F.col("s_nationkey").cast("string")
    kept = table(spark, sf_dir, "supplier").select(F.concat(F.lit("x"), nation).alias("canonical_id"), none.alias("doi"), F.col("s_suppkey").cast("string").alias("s2_id"), none.alias("arxiv_id"), none.alias("pubmed_id"), nation.alias("mag_id"), none.alias("dblp_id"), F.col("s_suppkey").alias("ord"))
    return X.id_map(papers, kept)


def _recursive(spark, sf_dir):
    lines, none = table(spark, sf_dir, "lineitem"), F.lit(None).cast("string")
    number = F.col("l_suppkey").cast("string")
    neighbours = lines.select(
        F.concat(F.lit("p"), "l_partkey").alias("paper_id"), F.when(F.col("l_returnflag") == "R", "citations").otherwise("references").alias("relation"),
        F.when(F.col("l_suppkey") % 11 != 0, F.concat(F.lit("paper "), number)).alias("title"), F.lit(2000).alias("year"), F.array(F.lit("A")).alias("authors"), none.alias("abstract"), none.alias("doi"), number.alias("corpus_id"), none.alias("arxiv"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"), "p_size")
    ids = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s2:"), F.col("s_suppkey").cast("string")).alias("key"), F.concat(F.lit("x"), F.col("s_suppkey").cast("string")).alias("canonical"))
    evaluated = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("x"), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("s2:"), F.col("s_suppkey").cast("string"))).alias("paper_id"))
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 5 = 0").select(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("x"), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("s2:"), F.col("s_suppkey").cast("string"))).alias("paper_id"))
    return X.recursive_expansion(parts.where("p_size > 30"), parts.where("p_size > 40"), evaluated, known, ids, neighbours)


_RUN = """q AS (SELECT 'p' || p_partkey AS paper_id FROM part WHERE p_size > 30 AND p_size <= 40),
w AS (SELECT 'p' || l_partkey AS paper_id, l_returnflag = 'R' AS cites, l_suppkey AS k, CASE WHEN l_suppkey % 2 = 0 THEN 'x' || l_suppkey ELSE 's2:' || l_suppkey END AS other FROM lineitem),
r AS (SELECT * FROM w WHERE paper_id IN (SELECT paper_id FROM q)), t AS (SELECT * FROM r WHERE k % 11 <> 0)"""


@query(f"""WITH {_RUN} SELECT (SELECT count(*) FROM part WHERE p_size > 30) AS seeds, (SELECT count(*) FROM q) AS expanded, (SELECT count(*) FROM t) AS edges_stored,
  (SELECT count(DISTINCT k) FROM t WHERE k % 3 <> 0 AND k % 5 <> 0) AS discovered, (SELECT count(DISTINCT k) FROM t WHERE k % 3 <> 0) AS pending_classification""")
def recursive_stats(spark, sf_dir):
    return _recursive(spark, sf_dir)["stats"]


@query(f"WITH {_RUN} SELECT CASE WHEN cites THEN other ELSE paper_id END AS src, CASE WHEN cites THEN paper_id ELSE other END AS dst FROM t")
def recursive_edges(spark, sf_dir):
    return _recursive(spark, sf_dir)["edges"]


@query(f"WITH {_RUN} SELECT q.paper_id, count(*) FILTER (NOT cites) AS n_refs, count(*) FILTER (cites) AS n_cites FROM q LEFT JOIN r USING (paper_id) GROUP BY 1")
def expansion_state(spark, sf_dir):
    return _recursive(spark, sf_dir)["state"]


@query(f"WITH {_RUN} SELECT DISTINCT other AS paper_id, 'paper ' || k AS title, CAST(k AS VARCHAR) AS corpus_id, 'run' AS source, 1 AS depth FROM t WHERE k % 3 <> 0 AND k % 5 <> 0")
def discovered_papers(spark, sf_dir):
    rows = X.discovered_records(_recursive(spark, sf_dir)["discovered"], "run", F.lit("now"))
    return rows.select("paper_id", "title", F.col("external_ids")["CorpusId"].alias("corpus_id"), "provenance.source", "provenance.depth")


# ------------------------------------------------------------------ backfill and seeds
def _gappy(spark, sf_dir):
    """Parts that lack a title, year or venue at times, with ids of several kinds."""
    key = F.col("p_partkey")
    number = key.cast("string")
    when = lambda c, x: F.when(c, x)
    return table(spark, sf_dir, "part").select(
        F.when(key % 10 == 9, F.concat(F.lit("hash:"), number)).otherwise(F.concat(F.lit("p"), number)).alias("paper_id"),
        when(key % 2 == 0, F.col("p_name")).alias("title"), when(key % 3 != 0, F.col("p_size") + 1985).alias("year"), when(key % 5 != 0, F.col("p_brand")).alias("venue"),
        when(key % 4 == 0, F.concat(F.lit("10.1/AB"), number)).alias("doi"), when(key % 4 == 1, number).alias("corpus_id"), when(key % 4 == 2, F.concat(F.lit("https://openalex.org/W"), number)).alias("openalex_id"), key.alias("ord"),
    )


_GAPPY = """g AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 9 THEN 'hash:' ELSE 'p' END || p_partkey AS paper_id, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title, CASE WHEN p_partkey % 3 <> 0 THEN p_size + 1985 END AS year,
  CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS venue, p_name, p_size, p_type FROM part)"""


@query(f"""WITH {_GAPPY}, m AS (SELECT * FROM g WHERE title IS NULL OR year IS NULL OR venue IS NULL)
SELECT (SELECT count(*) FROM g) AS total, count(*) AS missing, count(*) FILTER (k % 4 = 0) AS has_doi, count(*) FILTER (k % 4 = 1) AS has_corpus_id, count(*) FILTER (k % 4 = 2) AS has_openalex_id, count(*) FILTER (k % 10 = 9 AND k % 4 = 3) AS hash_only_unfetchable FROM m""")
def backfill_dry_run(spark, sf_dir):
    return B.missing_counts(_gappy(spark, sf_dir))


def _responses(spark, sf_dir):
    """Cached responses: works of parts by id or DOI, and pages of citations with a part by corpus id on either side."""
    key = F.col("p_partkey")
    number, part = key.cast("string"), table(spark, sf_dir, "part")
    venue = F.struct(F.struct(F.col("p_type").alias("display_name")).alias("source"))
    index = F.create_map(F.lit("small"), F.array(F.lit(1)), F.concat(F.lit("w"), number), F.array(F.lit(0), F.lit(2)))
    work = F.struct(F.concat(F.lit("https://openalex.org/W"), number).alias("id"), F.concat(F.lit("https://doi.org/10.1/ab"), number).alias("doi"), (F.col("p_size") + 1900).alias("publication_year"), venue.alias("primary_location"), index.alias("abstract_inverted_index"))
    record = F.struct(number.alias("corpusId"), F.concat(F.lit("V"), number).alias("venue"), (F.col("p_size") + 1950).alias("year"))
    page = F.struct(F.array(F.struct(F.when(key % 8 == 1, record).alias("citedPaper"), F.when(key % 8 == 5, record).alias("citingPaper"))).alias("data"))
    works = part.where("p_partkey % 4 in (0, 2)").select(key.alias("ord"), F.to_json(work).alias("value"))
    return works.unionByName(part.where("p_partkey % 4 = 1").select(key.alias("ord"), F.to_json(page).alias("value"))).unionByName(part.where("p_partkey = 3").select(key.alias("ord"), F.lit("{torn").alias("value")))


@query(f"""WITH {_GAPPY}, f AS (SELECT *, k % 4 IN (0, 1, 2) AS hit, CASE WHEN k % 4 = 1 THEN 'V' || k ELSE p_type END AS new_venue, CASE WHEN k % 4 = 1 THEN p_size + 1950 ELSE p_size + 1900 END AS new_year FROM g)
SELECT paper_id, title, coalesce(year, new_year) AS year, coalesce(venue, new_venue) AS venue, CASE WHEN k % 4 = 1 THEN 's2_cache' ELSE 'openalex_cache' END AS source, 0.7::DOUBLE AS confidence FROM f WHERE hit AND (year IS NULL OR venue IS NULL)""")
def cache_backfill(spark, sf_dir):
    papers = _gappy(spark, sf_dir)
    found = B.mined_metadata(papers, _responses(spark, sf_dir))
    rows = B.filled(papers, found, F.lit("now"), 0.7)
    return rows.select("paper_id", "title", "year", "venue", "provenance.source", "provenance.confidence")


@query(f"WITH {_GAPPY} SELECT paper_id, 'w' || k || ' small w' || k AS abstract, 'openalex' AS source FROM g WHERE k % 4 IN (0, 2)")
def cache_abstracts(spark, sf_dir):
    return B.mined_abstracts(_gappy(spark, sf_dir), _responses(spark, sf_dir))


@query(f"""WITH {_GAPPY} SELECT paper_id, CASE WHEN k % 2 = 0 AND k % 6 <> 0 THEN 'doi ' || k ELSE 'title ' || k END AS abstract, CASE WHEN k % 2 = 0 AND k % 6 <> 0 THEN 'epmc' ELSE 'title' END AS source FROM g WHERE k % 10 <> 0""")
def abstract_phases(spark, sf_dir):
    """Two phases: even parts by DOI, but for those that were tried; then all that is left by title, but for some tried."""
    papers = _gappy(spark, sf_dir).select("paper_id", "ord")
    tried = papers.where("ord % 6 = 0").select(F.concat(F.lit("epmc:"), "paper_id").alias("key")).unionByName(papers.where("ord % 10 = 0").select(F.concat(F.lit("title:"), "paper_id").alias("key")))
    tried = tried.unionByName(papers.where("ord % 10 = 0").select(F.concat(F.lit("epmc:"), "paper_id").alias("key")))
    by_doi = lambda rows: rows.select("paper_id", F.when(F.col("ord") % 2 == 0, F.concat(F.lit("<b>doi</b> "), F.col("ord").cast("string"))).alias("abstract"))
    by_title = lambda rows: rows.select("paper_id", F.concat(F.lit("title "), F.col("ord").cast("string")).alias("abstract"))
    return B.in_phases(papers, tried, [("epmc", by_doi), ("title", by_title)])


@query("""WITH t AS (SELECT page_id, trim(regexp_replace(lower(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '[^a-z0-9]+', ' ', 'g')) AS a FROM pages),
h AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN a WHEN 1 THEN a || ' and its subtitle' ELSE 'other ' || a[1:8] END AS b FROM t)
SELECT CAST(page_id AS VARCHAR) AS paper_id, 'found ' || page_id AS abstract FROM t JOIN h USING (page_id) WHERE a <> '' AND (a = b OR (length(a) > 20 AND contains(b, a)) OR (length(b) > 20 AND length(b) < length(a) AND contains(a, b)))""")
def title_candidates(spark, sf_dir):
    """Pages search their titles; the hit of a third has a subtitle, and that of another third has another title."""
    title = text.title_key(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1))
    papers = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("paper_id"), title.alias("key"), "page_id")
    kind = F.col("page_id") % 3
    hit = F.when(kind == 0, F.col("key")).when(kind == 1, F.concat("key", F.lit(" and its subtitle"))).otherwise(F.concat(F.lit("other "), F.substring("key", 1, 8)))
    hits = papers.select("paper_id", hit.alias("key"), F.concat(F.lit("found "), "paper_id").alias("abstract"), F.col("page_id").alias("ord"))
    return B.title_candidates(papers, hits)


@query(f"""WITH {_GAPPY}, pos AS (SELECT paper_id, k FROM g WHERE k % 3 = 0 OR k % 7 = 0 UNION ALL SELECT 'lone' || k, NULL FROM g WHERE k = 5)
SELECT pos.paper_id, CASE WHEN g.k % 14 = 0 THEN 'An EEG study' ELSE g.title END AS title, g.year, CASE WHEN g.k % 4 = 0 THEN 'New ' || coalesce(g.venue, 'one') ELSE g.venue END AS venue,
  CASE WHEN g.k % 28 = 0 THEN 'resting-state fMRI too' WHEN g.k % 2 = 1 THEN 'late ' || g.k END AS abstract
FROM pos LEFT JOIN g ON g.paper_id = pos.paper_id WHERE g.k IS NULL OR g.k % 14 <> 0 OR g.k % 28 = 0""")
def consolidated_seeds(spark, sf_dir):
    """Two logs of positives; discovered papers overlay a quarter's venues; a fourteenth is about EEG, half of them with fMRI."""
    rows, key = _gappy(spark, sf_dir), F.col("ord")
    none = F.lit(None).cast("string")
    fixed_title = F.when(key % 14 == 0, F.lit("An EEG study")).otherwise(F.col("title"))
    papers = rows.select("paper_id", fixed_title.alias("title"), "year", "venue", F.when(key % 28 == 0, F.lit("resting-state fMRI too")).alias("abstract"), "ord")
    over = rows.where(key % 4 == 0).select("paper_id", none.alias("title"), F.lit(None).cast("int").alias("year"), F.concat(F.lit("New "), F.coalesce("venue", F.lit("one"))).alias("venue"), none.alias("abstract"), "ord")
    late = rows.where(key % 2 == 1).select("paper_id", F.concat(F.lit("late "), key.cast("string")).alias("abstract"), "ord")
    lone = rows.where("ord = 5").select(F.concat(F.lit("lone"), key.cast("string")).alias("paper_id"))
    return B.consolidated_seeds([rows.where("ord % 3 = 0"), rows.where("ord % 7 = 0").select("paper_id").unionByName(lone)], papers, over, late)


@query("""WITH l AS (SELECT user_id AS paper_id, arg_max(event_type, event_id) AS category FROM events GROUP BY 1),
s AS (SELECT *, row_number() OVER (ORDER BY md5('7:' || paper_id), paper_id) - 1 AS k FROM l)
SELECT paper_id, category, CAST(k // 20 AS INT) AS batch FROM s WHERE k < 100""")
def audit_batches(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("paper_id"), F.col("event_type").alias("category"), F.col("event_id").alias("ord"))
    return L.audit_batches(log, sample=100, size=20, seed=7)


# ------------------------------------------------------------------ identifiers and records
_IDS = """i AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'doi:10.1/' || p_partkey WHEN 1 THEN 's2:' || p_partkey WHEN 2 THEN 'oa:W' || p_partkey ELSE 'PMC:' || p_partkey END AS paper_id,
  CASE WHEN p_size % 3 = 0 THEN '10.2/' || p_size ELSE '' END AS doi, CASE WHEN p_size % 5 = 0 THEN CAST(p_size AS VARCHAR) END AS corpus FROM part)"""


def _ids(spark, sf_dir):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 4
    paper_id = F.when(kind == 0, F.concat(F.lit("doi:10.1/"), key)).when(kind == 1, F.concat(F.lit("s2:"), key)).when(kind == 2, F.concat(F.lit("oa:W"), key)).otherwise(F.concat(F.lit("PMC:"), key))
    doi = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("10.2/"), size)).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", paper_id.alias("paper_id"), doi.alias("doi"), F.when(F.col("p_size") % 5 == 0, size).alias("corpus"))


@query(f"""WITH {_IDS} SELECT k AS p_partkey, CASE WHEN k % 4 = 0 THEN '10.1/' || k WHEN k % 4 = 1 THEN 'CorpusId:' || k WHEN doi <> '' THEN doi WHEN corpus IS NOT NULL THEN 'CorpusId:' || corpus END AS expansion,
  CASE WHEN corpus IS NOT NULL THEN corpus WHEN doi <> '' THEN doi WHEN k % 4 = 1 THEN CAST(k AS VARCHAR) WHEN k % 4 = 0 THEN '10.1/' || k END AS citation, CASE WHEN k % 4 = 2 THEN 'W' || k END AS openalex, CASE WHEN k % 4 = 3 THEN CAST(k AS VARCHAR) ELSE '' END AS pmc FROM i""")
def lookup_variants(spark, sf_dir):
    paper_id, doi, corpus, none = F.col("paper_id"), F.col("doi"), F.col("corpus"), F.lit(None).cast("string")
    return _ids(spark, sf_dir).select(
        "p_partkey", text.expansion_lookup(paper_id, doi, corpus).alias("expansion"), text.citation_lookup(paper_id, doi, corpus).alias("citation"),
        text.openalex_lookup(paper_id, none).alias("openalex"), text.external_id(none, paper_id, "pmc").alias("pmc"),
    )


@query("SELECT p_partkey, 'doi:10.1/ab' || p_size AS doi, 's2:' || p_partkey AS s2, 'mag:' || p_size AS mag FROM part")
def map_keys(spark, sf_dir):
    number = F.col("p_size").cast("string")
    doi = F.concat(F.lit(" https://doi.org/10.1/AB"), number)
    return table(spark, sf_dir, "part").select("p_partkey", text.map_key("doi", doi).alias("doi"), text.map_key("s2_id", F.col("p_partkey")).alias("s2"), text.map_key("mag_id", number).alias("mag"))


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_size > 40").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"), F.col("p_brand").alias("category"))


@query(f"WITH {_NET} SELECT node_type, coalesce(p_brand, 'out_of_scope') AS category, count(*) AS n FROM nodes LEFT JOIN (SELECT * FROM part WHERE p_size > 40) ON id = 'p' || p_partkey GROUP BY 1, 2")
def network_categories(spark, sf_dir):
    core, secondary, edges = network(spark, sf_dir)
    return C.category_distribution(C.network_nodes(core, secondary, C.boundary_nodes(edges)), _labelled(spark, sf_dir), fixed.EXCLUDED_CATEGORY)


@query(f"WITH {_NET} SELECT id AS paper_id, node_type, CASE WHEN p_size > 40 THEN p_brand ELSE 'out_of_scope' END AS category, p_name AS title, p_brand AS venue, p_size + 1985 AS year, CAST(floor(p_retailprice) AS INT) AS citation_count FROM nodes LEFT JOIN part ON id = 'p' || p_partkey")
def network_records(spark, sf_dir):
    core, secondary, edges = network(spark, sf_dir)
    return C.network_records(C.network_nodes(core, secondary, C.boundary_nodes(edges)), _labelled(spark, sf_dir), parts_of(spark, sf_dir), fixed.EXCLUDED_CATEGORY)


@query("""WITH s AS (SELECT s_nationkey AS k, arg_min('n' || s_suppkey, s_suppkey) AS late FROM supplier GROUP BY 1) SELECT n_nationkey AS paper_id, CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE late END AS abstract FROM nation LEFT JOIN s ON k = n_nationkey""")
def abstract_overlay(spark, sf_dir):
    """Nations have an abstract, none or an empty one; the first of their suppliers has one for those without."""
    key = F.col("n_nationkey")
    papers = table(spark, sf_dir, "nation").select(key.alias("paper_id"), F.when(key % 3 == 0, F.col("n_name")).when(key % 3 == 1, "").alias("abstract"))
    found = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("paper_id"), F.concat(F.lit("n"), "s_suppkey").alias("abstract"), F.col("s_suppkey").alias("ord"))
    return P.with_abstracts(papers, found)


@query(f"WITH {_P} SELECT venue, count(*) AS n FROM p GROUP BY 1 ORDER BY lower(venue), venue")
def venue_order(spark, sf_dir):
    return K.venues(parts_of(spark, sf_dir))


@query(f"""WITH {_P}, x AS (SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem), d AS (SELECT DISTINCT src, dst FROM x), g AS (SELECT dst AS id, count(*) AS n FROM d GROUP BY 1)
SELECT paper_id, coalesce(n, 0) AS in_degree, category LIKE 'fmri%' AS is_core, CASE WHEN CAST(substr(paper_id, 2) AS INT) % 2 = 0 THEN 'c' || year END AS cluster_id, year % 5 = 0 AS is_confirmed FROM p LEFT JOIN g ON id = paper_id""")
def clustered_stats(spark, sf_dir):
    papers = parts_of(spark, sf_dir)
    labels = papers.select("paper_id", "category", F.col("category").startswith("fmri").alias("is_core"))
    clusters = papers.where(F.substring("paper_id", 2, 20).cast("int") % 2 == 0).select("paper_id", F.concat(F.lit("c"), F.col("year").cast("string")).alias("cluster_id"))
    found = C.node_stats(C.clean_edges(edges_of(spark, sf_dir)), labels, papers.select("paper_id", "citation_count"), clusters, papers.where("year % 5 = 0"))
    return found.where(F.col("paper_id").startswith("p")).select("paper_id", "in_degree", "is_core", "cluster_id", "is_confirmed")
