"""Filling of missing metadata and abstracts from cached responses and services, phase after phase."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text

from .graph import cut_lineage
from .papers import backfilled, titles_match, with_abstracts

#: A cached response: a paper or work, or pages of citations around them.
CACHED = (
    "id string, doi string, publication_year int, abstract_inverted_index string, primary_location struct<source:struct<display_name:string>>, host_venue struct<display_name:string>, "
    "corpusId string, externalIds map<string,string>, title string, year int, venue string, abstract string, "
    "data array<struct<corpusId:string,externalIds:map<string,string>,title:string,year:int,venue:string,abstract:string,"
    "citedPaper:struct<corpusId:string,externalIds:map<string,string>,title:string,year:int,venue:string,abstract:string>,"
    "citingPaper:struct<corpusId:string,externalIds:map<string,string>,title:string,year:int,venue:string,abstract:string>>>"
)


def parsed_responses(responses: DataFrame, column: str = "value") -> DataFrame:
    """(ord, response columns) of JSON texts; what isn't JSON is left out.

    Texts are dealt out to all tasks, parsed once each and written: a filter or a field on a parsed column would parse it again,
    and so would each of those that read it.
    """
    parsed = F.explode(F.array(F.from_json(column, CACHED))).alias("r")
    return cut_lineage(responses.select("ord", column).repartition("ord").select("ord", parsed).where("r is not null").select("ord", "r.*"))


def works(responses: DataFrame) -> DataFrame:
    """(ord, openalex_id, doi, title, year, venue, index) of works; the venue is the primary location's, else the host's."""
    venue = F.coalesce(text.falsy_to_null(F.col("primary_location.source.display_name")), text.falsy_to_null(F.col("host_venue.display_name")))
    doi = text.falsy_to_null(F.lower(F.regexp_replace("doi", "^https://doi\\.org/", "")))
    return responses.select("ord", F.col("id").alias("openalex_id"), doi.alias("doi"), F.lit(None).cast("string").alias("title"), F.col("publication_year").alias("year"), venue.alias("venue"), F.col("abstract_inverted_index").alias("index"))


def cited_records(responses: DataFrame) -> DataFrame:
    """(ord, corpus_id, doi, title, year, venue, abstract) of papers: of a response itself, or of all its rows on either side."""
    fields = ("corpusId", "externalIds", "title", "year", "venue", "abstract")
    own = F.array(F.struct(*fields))
    each = lambda x: F.when(x["citedPaper"].isNull() & x["citingPaper"].isNull(), F.array(F.struct(*[x[f].alias(f) for f in fields]))).otherwise(F.array(x["citedPaper"], x["citingPaper"]))
    many = F.flatten(F.transform("data", each))
    rows = responses.select("ord", F.posexplode(F.when(F.col("data").isNull(), own).otherwise(many)).alias("at", "x")).where("x is not null")
    doi = text.falsy_to_null(F.lower(F.col("x.externalIds")["DOI"]))
    return rows.select(F.struct("ord", "at").alias("ord"), F.col("x.corpusId").alias("corpus_id"), doi.alias("doi"), "x.title", "x.year", "x.venue", "x.abstract")


def matched(papers: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """found rows with paper_id: by the first of `keys` that names a paper. Of papers with one key the last counts.

    All keys are one join, on their ranks and values alone, so that both sides are read once; a found row takes the best answer.
    """
    each = F.posexplode(F.array(*[F.when(text.has_text(F.col(k)), F.lower(k)) for k in keys])).alias("rank", "__key")
    owners = papers.select("paper_id", "ord", each).where("__key is not null").groupBy("rank", "__key").agg(F.max_by("paper_id", "ord").alias("paper_id"))
    rows = found.select("*", each).where("__key is not null").join(owners, ["rank", "__key"]).drop("__key")
    best = rows.groupBy("ord").agg(F.min_by(F.struct(*rows.columns), F.struct("rank", "paper_id")).alias("x"))
    return best.select("x.*").drop("rank")


def first_of_paper(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy("paper_id").agg(F.min_by(F.struct(*columns), "ord").alias("x")).select("paper_id", "x.*")


def mined_metadata(papers: DataFrame, responses: DataFrame) -> DataFrame:
    """(paper_id, title, year, venue, source) from cached works by id, then DOI; then from records by corpus id, then DOI."""
    parsed = parsed_responses(responses)
    from_works = matched(papers, works(parsed).where("venue is not null or year is not null"), ["openalex_id", "doi"])
    from_records = matched(papers, cited_records(parsed).where(text.has_text(F.col("venue"))).withColumn("title", F.lit(None).cast("string")), ["corpus_id", "doi"])
    both = first_of_paper(from_works, ["title", "year", "venue"]).withColumn("source", F.lit("openalex_cache")).withColumn("rank", F.lit(0))
    both = both.unionByName(first_of_paper(from_records, ["title", "year", "venue"]).withColumn("source", F.lit("s2_cache")).withColumn("rank", F.lit(1)))
    return both.groupBy("paper_id").agg(F.min_by(F.struct("title", "year", "venue", "source"), "rank").alias("x")).select("paper_id", "x.*")


def mined_abstracts(papers: DataFrame, responses: DataFrame) -> DataFrame:
    """(paper_id, abstract, source): of works by id, then DOI; of records by DOI, then corpus id. A paper keeps the first response's."""
    parsed = parsed_responses(responses)
    index = F.from_json("index", "map<string,array<int>>")
    of_works = matched(papers, works(parsed).where("index is not null"), ["openalex_id", "doi"]).select("paper_id", F.col("ord").cast("long").alias("ord"), text.abstract_of(index).alias("abstract"), F.lit("openalex").alias("source"))
    own = parsed.where(text.has_text(F.col("abstract"))).select("ord", F.col("corpusId").alias("corpus_id"), F.lower(F.col("externalIds")["DOI"]).alias("doi"), "abstract")
    of_records = matched(papers, own, ["doi", "corpus_id"]).select("paper_id", F.col("ord").cast("long").alias("ord"), "abstract", F.lit("semantic_scholar").alias("source"))
    rows = of_works.unionByName(of_records).where(text.has_text(F.col("abstract")))
    return rows.groupBy("paper_id").agg(F.min_by(F.struct("abstract", "source"), F.struct("ord", "source")).alias("x")).select("paper_id", "x.*")


def missing_counts(papers: DataFrame) -> DataFrame:
    """One row of what a backfill could do: papers (the last row of each id), those without title, year or venue, and by which id."""
    last = papers.where("paper_id is not null").groupBy("paper_id").agg(F.max_by(F.struct("title", "year", "venue", "doi", "corpus_id", "openalex_id"), "ord").alias("x")).select("paper_id", "x.*")
    missing = text.missing_metadata(F.col("title"), F.col("year"), F.col("venue"))
    has = lambda c: text.has_text(F.col(c))
    hash_only = F.col("paper_id").startswith("hash:") & ~has("doi") & ~has("corpus_id") & ~has("openalex_id")
    named = {"missing": F.lit(True), "has_doi": has("doi"), "has_corpus_id": has("corpus_id"), "has_openalex_id": has("openalex_id"), "hash_only_unfetchable": hash_only}
    return last.agg(F.count("*").alias("total"), *[F.count_if(missing & c).alias(name) for name, c in named.items()])


def filled(papers: DataFrame, found: DataFrame, fetched_at: Column, confidence: float) -> DataFrame:
    """The papers that `found` (paper_id, title, year, venue, source) changed, with the provenance of the change."""
    found = cut_lineage(found)  # it is read twice
    changed = backfilled(papers, found.drop("source")).where("changed").drop("changed")
    stamp = F.struct(F.col("__source").alias("source"), fetched_at.alias("fetched_at"), F.lit(confidence).alias("confidence"), F.lit(True).alias("backfill"))
    named = changed.join(found.select("paper_id", F.col("source").alias("__source")), "paper_id")
    return named.withColumn("provenance", stamp).drop("__source")


def in_phases(papers: DataFrame, processed: DataFrame, phases: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """(paper_id, abstract, source): each phase is asked for papers that none before found and that it didn't try already.

    processed (key) holds `phase:paper_id` of tries before; a phase returns (paper_id, abstract). A phase's answers are written
    before they are used: they are both part of the result and what the next phase needn't ask for.
    """
    left, found = papers, None
    for name, phase in phases:
        tried = processed.where(F.col("key").startswith(f"{name}:")).select(F.expr(f"substring(key, {len(name) + 2})").alias("paper_id"))
        got = phase(left.join(tried, "paper_id", "left_anti")).where(text.has_text(F.col("abstract")))
        got = got.select("paper_id", text.strip_html(F.col("abstract")).alias("abstract"), F.lit(name).alias("source")).dropDuplicates(["paper_id"])
        got = cut_lineage(got)
        found = got if found is None else found.unionByName(got)
        left = left.join(got.select("paper_id"), "paper_id", "left_anti")
    return found


def title_candidates(papers: DataFrame, hits: DataFrame) -> DataFrame:
    """(paper_id, abstract) of search hits (paper_id, title, abstract, ord) whose title is the paper's: the first such hit.

    Titles are compared in the loose form, `key` in both; a paper is only held against the hits of its own search.
    """
    pairs = papers.select("paper_id", F.col("key").alias("a")).join(hits.select("paper_id", F.col("key").alias("b"), "abstract", "ord"), "paper_id")
    near = pairs.where(titles_match(pairs, "a", "b") & text.has_text(F.col("abstract")))
    return near.groupBy("paper_id").agg(F.min_by("abstract", "ord").alias("abstract"))


def consolidated_seeds(positive: list[DataFrame], papers: DataFrame, discovered: DataFrame, abstracts: DataFrame) -> DataFrame:
    """Seeds that any log calls positive, with metadata (discovered papers first), without those about EEG alone.

    A seed without metadata stays, with its id alone. Abstracts only fill what is missing.
    """
    ids = reduce(DataFrame.unionByName, [p.select("paper_id") for p in positive]).where("paper_id is not null").distinct()
    columns = [c for c in papers.columns if c not in ("paper_id", "ord")]
    last = lambda df: df.join(ids, "paper_id", "left_semi").groupBy("paper_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c) for c in columns])
    old, new = last(papers), last(discovered).select("paper_id", *[F.col(c).alias(f"__{c}") for c in columns])
    joined = ids.join(old, "paper_id", "left").join(new, "paper_id", "left")
    rows = joined.select("paper_id", *[F.coalesce(f"__{c}", c).alias(c) for c in columns])
    rows = with_abstracts(rows, abstracts)
    return rows.where(~F.coalesce(text.eeg_only(F.col("title"), F.col("abstract")), F.lit(False)))
