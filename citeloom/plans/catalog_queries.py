"""Catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.functions import documents as D
from citeloom.functions import fixed, text
from citeloom.operators import catalog as K

from .graph_queries import parts_of
from .registry import query, table

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query("""SELECT year(o_orderdate) AS year, count(*) AS n_all, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT", count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH", count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-MEDIUM" FROM orders GROUP BY 1""")
def year_pivot(spark, sf_dir):
    papers = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("category"))
    return K.year_pivot(papers, _PRIORITIES)


@query("""
WITH v AS (SELECT CASE WHEN trim(regexp_replace(x, '\\s+', ' ', 'g')) = '' THEN 'Unknown venue' ELSE trim(regexp_replace(x, '\\s+', ' ', 'g')) END AS name
  FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN p_brand WHEN 1 THEN ' ' || p_type || '  x' WHEN 2 THEN CAST(p_size AS VARCHAR) WHEN 3 THEN '~' || p_name ELSE '' END AS x FROM part))
SELECT CASE WHEN name = 'Unknown venue' THEN 'unknown' WHEN upper(name[1]) BETWEEN 'A' AND 'Z' THEN lower(name[1]) WHEN name[1] BETWEEN '0' AND '9' THEN '0-9' ELSE 'other' END AS bucket, count(DISTINCT name) AS venues, count(*) AS papers FROM v GROUP BY 1""")
def venue_buckets(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    venue = F.when(kind == 0, F.col("p_brand")).when(kind == 1, F.concat(F.lit(" "), "p_type", F.lit("  x"))).when(kind == 2, F.col("p_size").cast("string")).when(kind == 3, F.concat(F.lit("~"), "p_name")).otherwise("")
    return K.venue_buckets(table(spark, sf_dir, "part").select(venue.alias("venue")))


@query("""
WITH s AS (SELECT unnest(['doi', 'arxiv', 'pubmed', 'other', 'pending']) AS source),
g AS (SELECT CASE page_id % 5 WHEN 0 THEN 'doi' WHEN 1 THEN 'arxiv' WHEN 2 THEN 'pubmed' WHEN 3 THEN CASE WHEN regexp_matches(url, '^https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[^?#]*)?$') THEN 'other' ELSE 'pending' END ELSE 'pending' END AS source FROM pages)
SELECT s.source, count(g.source) AS n FROM s LEFT JOIN g USING (source) GROUP BY 1""")
def source_groups(spark, sf_dir):
    kind = F.col("page_id") % 5
    number = F.col("page_id").cast("string")
    group = text.source_group(F.when(kind == 0, F.concat(F.lit("10.1/"), number)), F.when(kind == 1, number), F.when(kind == 2, number), F.lit(None).cast("string"), F.when(kind == 3, text.safe_url(F.col("url"))))
    return K.source_groups(table(spark, sf_dir, "pages"), list(fixed.SOURCE_GROUPS), group)


_P = "p AS (SELECT 'p' || p_partkey AS paper_id, p_name AS title, p_brand AS venue, CASE WHEN p_size > 5 THEN p_size + 1985 END AS year FROM part)"


def _papers(spark, sf_dir):
    return parts_of(spark, sf_dir).select("paper_id", "title", "venue", F.when(F.col("year") > 1990, F.col("year")).alias("year"))


@query(f"WITH {_P} SELECT paper_id, title, year FROM p ORDER BY year DESC NULLS LAST, lower(title), paper_id LIMIT 50 OFFSET 100")
def catalog_page(spark, sf_dir):
    return K.page(_papers(spark, sf_dir), 3).select("paper_id", "title", "year")


@query(f"WITH {_P} SELECT paper_id FROM p WHERE (contains(lower(paper_id), '19') OR contains(lower(title), '19') OR contains(lower(venue), '19') OR contains(CAST(year AS VARCHAR), '19')) AND year < 2000")
def catalog_filter(spark, sf_dir):
    papers = _papers(spark, sf_dir)
    return papers.where(K.any_column_contains(papers.columns, "19") & (F.col("year") < 2000)).select("paper_id")


@query(f"WITH {_P} SELECT paper_id, title FROM p WHERE contains(lower(title), 'ring') OR contains(lower(venue), 'ring') OR contains(CAST(year AS VARCHAR), 'ring') ORDER BY title, paper_id LIMIT 8")
def map_search(spark, sf_dir):
    papers = _papers(spark, sf_dir)
    return K.suggestions(papers, " Ring").unionByName(K.suggestions(papers, "r")).select("paper_id", "title")


@query(f"WITH {_P} SELECT DISTINCT year FROM p WHERE year IS NOT NULL")
def year_facet(spark, sf_dir):
    return _papers(spark, sf_dir).where("year is not null").select("year").distinct().orderBy(F.desc("year"))


@query("SELECT 'p' || p_partkey AS paper_id, CASE p_partkey % 4 WHEN 0 THEN 'https://doi.org/10.1/' || p_partkey WHEN 1 THEN 'https://arxiv.org/abs/' || p_partkey WHEN 2 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || p_partkey || '/' END AS link FROM part")
def first_links(spark, sf_dir):
    kind, number = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    link = text.first_link(F.when(kind == 0, F.concat(F.lit("10.1/"), number)), F.when(kind == 1, number), F.when(kind == 2, number), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"), link.alias("link"))


@query("""SELECT page_id, '[DOI](https://doi.org/10.1/' || page_id || ')' || CASE WHEN page_id % 2 = 0 THEN ' [PubMed](https://pubmed.ncbi.nlm.nih.gov/' || page_id || '/)' ELSE '' END
  || CASE WHEN NOT contains(url, '?') AND NOT contains(url, '#') THEN ' [Source: ' || split_part(url, '/', 3) || '](' || url || ')' ELSE '' END AS links FROM pages""")
def source_links(spark, sf_dir):
    none = F.lit(None).cast("string")
    pages = table(spark, sf_dir, "pages")
    links = D.source_links(F.concat(F.lit("doi:10.1/"), "page_id"), none, none, none, F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("string")), F.col("url"))
    return pages.select("page_id", F.array_join(links, " ").alias("links"))


@query(f"WITH {_P} SELECT paper_id, '- ' || title || ' — ' || replace(venue, '#', '#') || '. [DOI](https://doi.org/10.1/' || paper_id || ')' AS line FROM p")
def catalog_lines(spark, sf_dir):
    none = F.lit(None).cast("string")
    papers = _papers(spark, sf_dir)
    links = D.source_links(F.concat(F.lit("doi:10.1/"), "paper_id"), none, none, none, none, none)
    return papers.select("paper_id", K.paper_line(D.literal_markdown(F.col("title")), D.literal_markdown(F.col("venue")), links).alias("line"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'references' WHEN doc_id % 3 = 1 THEN 'Results > References' ELSE 'References > Notes' END AS heading, doc_id % 3 < 2 AS back FROM documents")
def back_matter(spark, sf_dir):
    kind = F.col("doc_id") % 3
    heading = F.when(kind == 0, "references").when(kind == 1, "Results > References").otherwise("References > Notes")
    return table(spark, sf_dir, "documents").select("doc_id", heading.alias("heading"), text.back_matter(heading).alias("back"))
