"""The neighbourhood of some papers: seeds, what they cite and what cites them, as nodes with roles and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text

#: Records as a service gives them, with how each was met.
RECORD = (
    "paperId string, corpusId string, title string, year int, venue string, authors array<struct<name:string>>, externalIds map<string,string>, "
    "citationCount int, referenceCount int, url string, openAccessPdf struct<url:string>, abstract string, fieldsOfStudy array<string>"
)
RECORD_FIELDS = ("paperId", "corpusId", "title", "year", "venue", "authors", "externalIds", "citationCount", "referenceCount", "url", "openAccessPdf", "abstract", "fieldsOfStudy")


def compact(records: DataFrame) -> DataFrame:
    """Records as nodes: ids, names of authors, whether an abstract is known; columns beyond a record's stay."""
    own, ids = set(RECORD_FIELDS), F.col("externalIds")
    return records.select(
        text.neighbourhood_key(F.col("paperId"), F.col("corpusId"), ids["DOI"], ids["ArXiv"], F.coalesce(text.falsy_to_null(F.col("title")), F.lit("untitled"))).alias("paper_id"),
        F.col("paperId").alias("s2_paper_id"),
        F.col("corpusId").alias("corpus_id"),
        "title",
        "year",
        "venue",
        F.filter(F.transform(F.coalesce("authors", F.array().cast("array<struct<name:string>>")), lambda a: a["name"]), text.has_text).alias("authors"),
        F.col("externalIds").alias("external_ids"),
        F.col("citationCount").alias("citation_count"),
        F.col("referenceCount").alias("reference_count"),
        "url",
        F.col("openAccessPdf.url").alias("open_access_pdf"),
        text.has_text(F.col("abstract")).alias("abstract_available"),
        F.coalesce("fieldsOfStudy", F.array().cast("array<string>")).alias("fields_of_study"),
        *[c for c in records.columns if c not in own],
    )


def nodes_of(met: DataFrame) -> DataFrame:
    """One node a paper of compact rows with role, seen_in and ord: the first row's data, all roles and all that it was seen in.

    Roles stand in order of their first row. A paper that very many others name has as long a list.
    """
    data = [c for c in met.columns if c not in ("paper_id", "role", "seen_in", "ord")]
    by_role = met.groupBy("paper_id", "role").agg(F.min("ord").alias("ord"))
    roles = by_role.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("ord", "role"))).alias("r"))
    seen = met.groupBy("paper_id").agg(F.min_by(F.struct(*data), "ord").alias("x"), F.array_sort(F.collect_list(F.struct("ord", "seen_in"))).alias("s"))
    return seen.join(roles, "paper_id").select("paper_id", "x.*", F.col("r.role").alias("roles"), F.col("s.seen_in").alias("seen_in"))


def neighbourhood(seeds: DataFrame, references: DataFrame, citations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of compact seeds (seen_in, ord) and compact neighbours (seed, ord).

    Edges go from the citing paper, with the relation in which they were met; an edge met in both is there twice.
    """
    named = lambda rows, role, seen: rows.withColumn("role", F.lit(role)).withColumn("seen_in", seen)
    met = named(seeds, "seed", F.col("seen_in"))
    for rows, role in ((references, "reference"), (citations, "citation")):
        met = met.unionByName(named(rows, role, F.concat(F.lit("seed:"), "seed")).drop("seed"))
    edges = references.select(F.col("seed").alias("source"), F.col("paper_id").alias("target"), F.lit("references").alias("relation"))
    edges = edges.unionByName(citations.select(F.col("paper_id").alias("source"), F.col("seed").alias("target"), F.lit("citations").alias("relation")))
    return nodes_of(met), edges


def top_neighbours(nodes: DataFrame, edges: DataFrame, relation: str, limit: int = 25) -> DataFrame:
    """The neighbours in a relation, most cited first, then newest, then by id; one met twice is listed twice."""
    end = "target" if relation == "references" else "source"
    near = edges.where(F.col("relation") == relation).select(F.col(end).alias("paper_id")).join(nodes, "paper_id")
    return near.orderBy(F.desc(F.coalesce("citation_count", F.lit(0))), F.desc(F.coalesce("year", F.lit(0))), "paper_id").limit(limit)


def summary(nodes: DataFrame, edges: DataFrame, queries: list[str], paper_ids: list[str], limit: int = 25) -> str:
    """A Markdown summary: inputs, seeds, and the first neighbours of either relation."""
    cell = lambda x: "" if x is None else str(x)

    def titled(r) -> str:
        title, at = (r["title"] or "Untitled").replace("|", "\\|"), r["open_access_pdf"] or r["url"]
        return f"[{title}]({at})" if at else title

    def listed(rows) -> list[str]:
        top = ["| Year | Citations | Title | Venue |", "|---|---:|---|---|"]
        return top + [f"| {cell(r['year'])} | {r['citation_count'] or 0} | {titled(r)} | {cell(r['venue'])} |" for r in rows]

    seeds = nodes.where(F.array_contains("roles", "seed")).orderBy("paper_id").toLocalIterator()
    lines = ["# Literature neighbourhood", "", f"Queries: {', '.join(queries) or 'none'}", f"Papers: {', '.join(paper_ids) or 'none'}", "", "## Seeds", "", *listed(seeds)]
    for relation, heading in (("references", "References"), ("citations", "Citing papers")):
        lines += ["", f"## {heading}", "", *listed(top_neighbours(nodes, edges, relation, limit).collect())]
    return "\n".join([*lines, ""])
