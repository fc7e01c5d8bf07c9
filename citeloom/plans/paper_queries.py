"""Identity, metadata and data-quality queries, and title search."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.functions import documents as D
from citeloom.functions import text
from citeloom.operators import papers as P
from citeloom.operators import title_join as J
from citeloom.operators import titles as S
from citeloom.sources import writers

from .graph_queries import edges_of, parts_of
from .registry import query, table


def _sources(spark, sf_dir):
    """Part as two incomplete sources of papers that overlap."""
    part = table(spark, sf_dir, "part")
    key = F.concat(F.lit("p"), "p_partkey").alias("paper_id")
    first = part.where("p_partkey % 3 <> 0").select(
        key, F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("").alias("title"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("year"), F.col("p_brand").alias("venue"), F.col("p_partkey").alias("ord")
    )
    second = part.where("p_partkey % 3 <> 1").select(key, F.upper("p_name").alias("title"), (F.col("p_size") + 100).alias("year"), F.when(F.col("p_size") > 20, F.col("p_type")).alias("venue"), F.col("p_partkey").alias("ord"))
    return first, second


_TWO = """
a AS (SELECT 'p' || p_partkey AS paper_id, CASE WHEN p_size > 10 THEN p_name ELSE '' END AS title, CASE WHEN p_size % 2 = 0 THEN p_size END AS year, p_brand AS venue FROM part WHERE p_partkey % 3 <> 0),
b AS (SELECT 'p' || p_partkey AS paper_id, upper(p_name) AS title, p_size + 100 AS year, CASE WHEN p_size > 20 THEN p_type END AS venue FROM part WHERE p_partkey % 3 <> 1)"""


@query(f"WITH {_TWO} SELECT paper_id, coalesce(nullif(a.title, ''), b.title) AS title, coalesce(a.year, b.year) AS year, coalesce(nullif(a.venue, ''), b.venue) AS venue FROM a FULL JOIN b USING (paper_id)")
def metadata_fill(spark, sf_dir):
    return P.fill_gaps(list(_sources(spark, sf_dir)))


@query(f"WITH {_TWO} SELECT paper_id, coalesce(b.title, a.title) AS title, coalesce(b.year, a.year) AS year, coalesce(b.venue, a.venue) AS venue FROM a FULL JOIN b USING (paper_id)")
def metadata_overlay(spark, sf_dir):
    return P.overlaid(*_sources(spark, sf_dir))


@query(f"""
WITH {_TWO}, j AS (SELECT a.*, b.title AS t, b.year AS y, b.venue AS v FROM a LEFT JOIN b USING (paper_id))
SELECT paper_id, CASE WHEN title = '' AND coalesce(t, '') <> '' THEN t ELSE title END AS title, CASE WHEN coalesce(year, 0) = 0 AND coalesce(y, 0) <> 0 THEN y ELSE year END AS year, venue,
  (title = '' AND coalesce(t, '') <> '') OR (coalesce(year, 0) = 0 AND coalesce(y, 0) <> 0) AS changed FROM j""")
def metadata_backfill(spark, sf_dir):
    first, second = _sources(spark, sf_dir)
    return P.backfilled(first.drop("ord"), second)


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'doi:10.1/' || lower(p_brand) WHEN 1 THEN 's2:' || p_size WHEN 2 THEN 'oa:W' || p_partkey
  ELSE 'hash:' || substr(sha1(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g') || '|' || p_size || '|' || regexp_replace(lower(p_brand), '[^a-z]', '', 'g')), 1, 12) END AS id FROM part""")
def canonical_ids(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    kind = F.col("p_partkey") % 4
    doi = F.when(kind == 0, F.concat(F.lit("https://doi.org/10.1/"), "p_brand"))
    return part.select("p_partkey", text.canonical_id(doi, F.when(kind == 1, F.col("p_size")), F.when(kind == 2, F.concat(F.lit("W"), "p_partkey")), F.col("p_name"), F.col("p_size"), F.col("p_brand")).alias("id"))


@query("""
SELECT page_id, trim(replace(regexp_replace(lower(trim(u)), '^https?://(dx\\.)?doi\\.org/', ''), 'doi:', '')) AS normalized,
  regexp_replace(regexp_replace(regexp_replace(lower(trim(u)), '^https://doi.org/', ''), '^http://doi.org/', ''), '^doi:', '') AS lookup
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://doi.org/' WHEN 1 THEN 'http://dx.doi.org/' WHEN 2 THEN ' DOI:' ELSE 'doi:10.5/doi:' END || url AS u FROM pages)""")
def doi_forms(spark, sf_dir):
    kind = F.col("page_id") % 4
    before = F.when(kind == 0, "https://doi.org/").when(kind == 1, "http://dx.doi.org/").when(kind == 2, " DOI:").otherwise("doi:10.5/doi:")
    raw = F.concat(before, "url")
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_doi(raw).alias("normalized"), text.lookup_doi(raw).alias("lookup"))


@query("""
WITH k AS (SELECT p_partkey, p_partkey % 5 AS k FROM part)
SELECT CASE k WHEN 0 THEN 'doi:10.1/A' || p_partkey WHEN 1 THEN 'arXiv:2001.' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') || 'v' || p_partkey WHEN 2 THEN CAST(p_partkey AS VARCHAR) WHEN 3 THEN 'W' || p_partkey ELSE '?' || p_partkey END AS raw,
  CASE k WHEN 0 THEN 'doi' WHEN 1 THEN 'arxiv' WHEN 2 THEN 'digits' WHEN 3 THEN 'openalex' END AS kind,
  CASE WHEN k IN (0, 1) OR (k = 2 AND p_partkey % 2 = 0) THEN 'c' || p_partkey END AS canonical FROM k""")
def resolve_ids(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 5).alias("k"))
    number, named = F.col("p_partkey").cast("string"), F.concat(F.lit("c"), "p_partkey").alias("canonical")
    arxiv = F.concat(F.lit("2001."), F.lpad((F.col("p_partkey") % 100_000).cast("string"), 5, "0"), F.lit("v"), "p_partkey")
    raw = (
        F.when(F.col("k") == 0, F.concat(F.lit("doi:10.1/A"), number))
        .when(F.col("k") == 1, F.concat(F.lit("arXiv:"), arxiv))
        .when(F.col("k") == 2, number)
        .when(F.col("k") == 3, F.concat(F.lit("W"), number))
        .otherwise(F.concat(F.lit("?"), number))
    )
    ids = part.where("k = 0").select(F.lit("doi").alias("kind"), F.concat(F.lit("10.1/a"), number).alias("value"), named)
    ids = ids.union(part.where("k = 1").select(F.lit("doi"), F.concat(F.lit("10.48550/arxiv."), arxiv), named))
    ids = ids.union(part.where("k = 2 and p_partkey % 2 = 0").select(F.lit("pubmed"), number, named))
    return P.resolved_ids(part.select(raw.alias("raw")), ids)


@query("""
SELECT doc_id, t LIKE '%eeg%' AND NOT t LIKE '%fmri%' AS eeg FROM (SELECT doc_id, lower(CASE doc_id % 3 WHEN 0 THEN 'An EEG study' WHEN 1 THEN 'Resting fMRI and eeg' ELSE 'Other' END) AS t FROM documents)""")
def eeg_only(spark, sf_dir):
    title = F.when(F.col("doc_id") % 3 == 0, "An EEG study").when(F.col("doc_id") % 3 == 1, "Resting fMRI and eeg").otherwise("Other")
    return table(spark, sf_dir, "documents").select("doc_id", text.eeg_only(title, F.col("text")).alias("eeg"))


@query(f"WITH {_TWO} SELECT count(*) FILTER (trim(title) = '' OR year IS NULL OR coalesce(trim(venue), '') = '') AS n FROM a")
def missing_metadata(spark, sf_dir):
    first, _ = _sources(spark, sf_dir)
    return first.where(text.missing_metadata(F.col("title"), F.col("year"), F.col("venue"))).agg(F.count("*").alias("n"))


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING n > 1")
def duplicate_ids(spark, sf_dir):
    return P.duplicate_ids(table(spark, sf_dir, "conversations"), "conv_id")


@query(f"""
WITH {_TWO}, e AS (SELECT 'p' || l_partkey AS dst, 'o' || l_orderkey AS src FROM lineitem)
SELECT 0::BIGINT AS duplicate_ids, (SELECT count(*) FILTER (title = '' OR year IS NULL OR venue IS NULL) FROM a) AS missing_metadata, 0::BIGINT AS missing_provenance, (SELECT count(*) FROM e WHERE src NOT IN (SELECT paper_id FROM a) OR dst NOT IN (SELECT paper_id FROM a)) AS broken_edges""")
def quality_report(spark, sf_dir):
    first, _ = _sources(spark, sf_dir)
    papers = first.withColumn("source", F.lit("driver")).withColumn("fetched_at", F.lit("2024-01-01"))
    return P.quality_report(papers, edges_of(spark, sf_dir))


@query("SELECT count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def broken_edges(spark, sf_dir):
    papers = parts_of(spark, sf_dir).where("year > 1990").select("paper_id")
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("paper_id"))
    return P.broken_edges(edges_of(spark, sf_dir), papers.union(orders)).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT lower(trim(name)) AS name, paper_id FROM (SELECT c_custkey AS paper_id, ' ' || c_name AS name FROM customer UNION ALL SELECT o_custkey, 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders)")
def papers_by_author(spark, sf_dir):
    side = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.concat(F.lit(" "), "c_name").alias("author"))
    inline = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("paper_id"), F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("author"))
    return P.paper_ids_by_name(side, inline, "author")


@query("SELECT DISTINCT lower(trim(c_mktsegment)) AS name, c_custkey AS paper_id FROM customer")
def papers_in_venue(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.col("c_mktsegment").alias("venue"))
    return P.paper_ids_by_name(rows, rows.limit(0), "venue")


@query(f"""
WITH {_TWO} SELECT paper_id AS canonical_id, coalesce(nullif(a.title, ''), b.title) AS title, coalesce(a.year, b.year) AS year, coalesce(a.venue, b.venue) AS venue, CASE WHEN a.year > 30 THEN 'new' END AS category, b.paper_id IS NOT NULL AS has_fulltext
FROM a FULL JOIN b USING (paper_id)""".replace("b.paper_id IS NOT NULL", "b.title IS NOT NULL"))
def paper_records(spark, sf_dir):
    first, second = _sources(spark, sf_dir)
    labels = first.where("year > 30").select("paper_id", F.lit("new").alias("category"), F.lit(3).alias("tier"), F.lit("high").alias("confidence"))
    corpus = second.select("paper_id", "title", "year", "venue", F.concat(F.col("paper_id"), F.lit(".md")).alias("fulltext_file"))
    return P.paper_records(first.drop("ord"), labels, corpus).select("canonical_id", "title", "year", "venue", "category", "has_fulltext")


def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("paper_id"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), "url")


_TITLES = "t AS (SELECT page_id AS paper_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages)"
_STOP = "['the', 'for', 'and', 'with', 'via', 'using', 'based', 'toward', 'towards', 'from', 'are', 'our', 'use', 'new', 'novel', 'approach', 'method', 'methods', 'model', 'models', 'network', 'networks', 'study', 'analysis']"
_TOKENS = f"k AS (SELECT paper_id, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda x: len(x) >= 3 AND NOT list_contains({_STOP}, x))) AS tokens FROM t)"


@query(f"WITH {_TITLES}, {_TOKENS} SELECT paper_id, array_to_string(list_sort(tokens), ' ') AS tokens FROM k WHERE len(tokens) > 0")
def title_tokens(spark, sf_dir):
    found = S.tokenized(page_titles(spark, sf_dir))
    return found.select("paper_id", F.array_join(F.array_sort("tokens"), " ").alias("tokens"))


@query(f"""
WITH {_TITLES}, {_TOKENS}, q AS (SELECT ['that', 'was', 'tion', 'here', 'que', 'die'] AS q),
df AS (SELECT w, count(paper_id) AS n FROM (SELECT unnest(q) AS w FROM q) LEFT JOIN (SELECT paper_id, unnest(tokens) AS x FROM k) ON w = x GROUP BY 1),
seeds AS (SELECT list(w) AS s FROM (SELECT w FROM df ORDER BY n, w LIMIT 4)),
c AS (SELECT paper_id, tokens, len(list_intersect(tokens, q)) AS shared FROM k, q, seeds WHERE list_has_any(tokens, s))
SELECT paper_id, round_even(0.5::DOUBLE * shared / (len(tokens) + 6 - shared) + 0.5::DOUBLE * shared / 6, 4) AS score FROM c ORDER BY score DESC, paper_id LIMIT 20""")
def title_search(spark, sf_dir):
    return S.search_titles(S.tokenized(page_titles(spark, sf_dir)), "That was tion here, que die")


@query(f"""
WITH {_TITLES}, {_TOKENS}, q AS (SELECT list_append(tokens, 'extraordinary') AS q FROM k ORDER BY len(tokens) DESC, paper_id LIMIT 1),
df AS (SELECT w, count(paper_id) AS n FROM (SELECT unnest(q) AS w FROM q) LEFT JOIN (SELECT paper_id, unnest(tokens) AS x FROM k) ON w = x GROUP BY 1),
seeds AS (SELECT list(w) AS s FROM (SELECT w FROM df ORDER BY n, w LIMIT 4)),
c AS (SELECT paper_id, len(list_intersect(tokens, q)) AS shared, len(tokens) AS own, len(q) AS asked FROM k, q, seeds WHERE list_has_any(tokens, s)),
r AS (SELECT paper_id, shared / (own + asked - shared)::DOUBLE AS score FROM c ORDER BY score DESC, paper_id LIMIT 1)
SELECT paper_id, score FROM r WHERE score >= 0.85""")
def resolve_by_title(spark, sf_dir):
    """The longest title with a word more: the best is near, not equal."""
    titles = S.tokenized(page_titles(spark, sf_dir))
    longest = titles.orderBy(F.desc(F.size("tokens")), "paper_id").first()
    return S.resolve_by_title(titles, longest["title"] + " extraordinary")


@query("""
SELECT count(*) FILTER (m) AS matches, count(*) AS n FROM (SELECT a = b OR (length(CASE WHEN length(a) < length(b) THEN a ELSE b END) > 20 AND contains(CASE WHEN length(a) < length(b) THEN b ELSE a END, CASE WHEN length(a) < length(b) THEN a ELSE b END)) AS m
FROM (SELECT lower(c_name) AS a, lower(c_name) || CASE WHEN c_custkey % 2 = 0 THEN ' the second part' ELSE '' END AS b FROM customer))""")
def title_matches(spark, sf_dir):
    name = F.lower("c_name")
    pairs = table(spark, sf_dir, "customer").select(name.alias("a"), F.concat(name, F.when(F.col("c_custkey") % 2 == 0, " the second part").otherwise("")).alias("b"))
    return pairs.agg(F.count_if(P.titles_match(pairs, "a", "b")).alias("matches"), F.count("*").alias("n"))


@query(f"WITH {_TITLES} SELECT paper_id, trim(regexp_replace(regexp_replace(strip_accents(lower(title)), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g')) AS key FROM t")
def loose_titles(spark, sf_dir):
    return page_titles(spark, sf_dir).select("paper_id", D.normalize_loosely("title").alias("key"))


_LOOSE = "trim(regexp_replace(regexp_replace(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"""
WITH {_TITLES}, a AS (SELECT {_LOOSE.format("title")} AS key, count(*) AS n FROM t GROUP BY 1),
b AS (SELECT {_LOOSE.format("split_part(text, chr(10), 1)")} AS key, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT a.key AS left, b.key AS right, a.n AS n_left, b.n AS n_right FROM a JOIN b ON a.key <> '' AND b.key <> '' AND (a.key = b.key
  OR (length(a.key) > 20 AND length(a.key) < length(b.key) AND contains(b.key, a.key)) OR (length(b.key) > 20 AND length(b.key) < length(a.key) AND contains(a.key, b.key)))""")
def matching_titles(spark, sf_dir):
    """All titles of pages with the first lines of all documents."""
    pages = page_titles(spark, sf_dir).select(D.normalize_loosely("title").alias("key"))
    lines = table(spark, sf_dir, "documents").where("text is not null").select(D.normalize_loosely(F.split_part("text", F.lit("\n"), F.lit(1))).alias("key"))
    return J.matching_titles(pages, lines)


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)")
def insert_new(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return writers.insert_new(rows.union(rows), seen, ["p_partkey"], F.col("p_name"))


@query("""SELECT p_partkey, coalesce(CASE p_partkey % 3 WHEN 0 THEN 'CorpusId:' || p_size END, CASE p_partkey % 3 WHEN 1 THEN 'CorpusId:' || p_partkey END, '10.1/' || p_partkey) AS lookup,
  CASE p_partkey % 3 WHEN 0 THEN 'corpus:' || p_size ELSE 'title:' || replace(p_name, ' ', '-') END AS near FROM part""")
def lookup_ids(spark, sf_dir):
    kind = F.col("p_partkey") % 3
    corpus = F.when(kind == 0, F.col("p_size"))
    paper = F.when(kind == 1, F.concat(F.lit("s2:"), "p_partkey")).when(kind == 2, F.concat(F.lit("doi:10.1/"), "p_partkey"))
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", text.lookup_id(corpus, paper, none).alias("lookup"), text.neighbourhood_key(none, corpus, none, none, F.col("p_name")).alias("near"))


@query("SELECT doc_id, array_to_string(string_split_regex(text, ' +'), ' ') AS abstract FROM documents")
def abstracts(spark, sf_dir):
    """Texts to inverted indexes and back; runs of spaces become one."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.abstract_of(D.inverted_index(F.split("text", " +"))).alias("abstract"))


@query("SELECT role, length(word) AS size, count(*) AS n FROM (SELECT role, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM conversations) WHERE length(word) > 0 GROUP BY 1, 2")
def exploded_words(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").select("role", F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where("word <> ''")
    return words.groupBy("role", F.length("word").alias("size")).agg(F.count("*").alias("n"))
