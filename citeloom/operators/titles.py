"""Lexical search over titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text

from .graph import cut_lineage

#: Only the rarest words of a query seed its candidates; results depend on it.
SEED_WORDS = 4


def tokenized(papers: DataFrame, title: str = "title") -> DataFrame:
    """papers with a title of at least one token, and `tokens`."""
    return papers.withColumn("tokens", text.title_tokens(F.col(title))).where(F.size("tokens") > 0)


def query_tokens(spark: SparkSession, query: str) -> list[str]:
    if not query or not query.strip():
        raise ValueError("a query needs text")
    return spark.range(1).select(text.title_tokens(F.lit(query)).alias("t")).first()["t"]


def postings(titles: DataFrame) -> DataFrame:
    """(token, paper_id) of tokenized titles, written in order of the token: a query reads the parts that hold its tokens."""
    rows = titles.select(F.explode("tokens").alias("token"), "paper_id")
    return cut_lineage(rows.repartitionByRange("token").sortWithinPartitions("token", "paper_id"))


def candidates(titles: DataFrame, tokens: list[str], index: DataFrame | None = None) -> DataFrame:
    """Titles with one of the query's rarest tokens, ties in order of the token. The index is postings(titles)."""
    index = postings(titles) if index is None else index
    counts = {r["token"]: r["n"] for r in index.where(F.col("token").isin(tokens)).groupBy("token").agg(F.count("*").alias("n")).collect()}  # a row a query token at most
    seeds = sorted(tokens, key=lambda t: (counts.get(t, 0), t))[:SEED_WORDS]
    return titles.join(index.where(F.col("token").isin(seeds)).select("paper_id").distinct(), "paper_id", "left_semi")


def scored(found: DataFrame, tokens: list[str], top_k: int) -> DataFrame:
    """(paper_id, score) of the best: half Jaccard similarity of the tokens, half coverage of the query, to four digits."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    shared = F.size(F.array_intersect("tokens", wanted))
    score = F.bround(0.5 * shared / F.size(F.array_union("tokens", wanted)) + 0.5 * shared / len(tokens), 4)
    return found.select("paper_id", score.alias("score")).orderBy(F.desc("score"), "paper_id").limit(top_k)


def search_titles(titles: DataFrame, query: str, *, top_k: int = 20, where=None, index: DataFrame | None = None) -> DataFrame:
    """The best titles for a query; a condition narrows what is scored, not what seeds the candidates."""
    tokens = query_tokens(titles.sparkSession, query)
    if not tokens:
        return titles.select("paper_id", F.lit(0.0).alias("score")).limit(0)
    found = candidates(titles, tokens, index)
    return scored(found if where is None else found.where(where), tokens, top_k)


def resolve_by_title(titles: DataFrame, title: str, *, year: int | None = None, authors: list[str] | None = None, min_score: float = 0.85, index: DataFrame | None = None) -> DataFrame:
    """(paper_id, score) of the best title by Jaccard similarity; a shared surname adds 0.02; ties go to the smaller id."""
    tokens = query_tokens(titles.sparkSession, title)
    if not tokens:
        return titles.select("paper_id", F.lit(0.0).alias("score")).limit(0)
    wanted = F.array(*[F.lit(t) for t in tokens])
    found = candidates(titles, tokens, index)
    if year is not None:
        found = found.where(F.col("year").isNull() | (F.col("year") == year))
    score = F.size(F.array_intersect("tokens", wanted)) / F.size(F.array_union("tokens", wanted))
    surnames = [a.split()[-1].lower() for a in authors or [] if a.split()]
    if surnames:
        own = F.transform("authors", lambda a: F.element_at(F.split(F.trim(F.lower(a)), r"\s+"), -1))
        score = F.when(F.arrays_overlap(own, F.array(*[F.lit(s) for s in surnames])), F.least(F.lit(1.0), score + 0.02)).otherwise(score)
    best = found.select("paper_id", score.alias("score")).orderBy(F.desc("score"), "paper_id").limit(1)
    return best.where(F.col("score") >= min_score)
