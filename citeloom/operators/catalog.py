"""Roll-ups and pages of the paper catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text


def catalog_papers(records: DataFrame, categories: list[str]) -> DataFrame:
    return records.where(F.col("category").isin(*categories) & text.has_text(F.col("title")))


def year_pivot(papers: DataFrame, categories: list[str]) -> DataFrame:
    """(year, all, one column a category); papers without a year are one row."""
    return papers.groupBy("year").agg(F.count("*").alias("n_all"), *[F.count_if(F.col("category") == c).alias(c) for c in categories])


def venue_buckets(papers: DataFrame, venue: str = "venue") -> DataFrame:
    name = text.venue_name(F.col(venue))
    return papers.groupBy(text.venue_bucket(name).alias("bucket")).agg(F.countDistinct(name).alias("venues"), F.count("*").alias("papers"))


def source_groups(papers: DataFrame, groups: list[str], group: Column) -> DataFrame:
    """(source, n) of every group, also empty ones."""
    counts = papers.groupBy(group.alias("source")).agg(F.count("*").alias("n"))
    known = papers.sparkSession.createDataFrame([(g,) for g in groups], "source string")
    return known.join(counts, "source", "left").na.fill(0, ["n"])


def catalog_order() -> list[Column]:
    """Newest first, papers without a year last, then title and id."""
    return [F.desc_nulls_last("year"), F.lower("title"), F.asc("paper_id")]


def page(papers: DataFrame, number: int, size: int = 50) -> DataFrame:
    return papers.orderBy(*catalog_order()).offset((number - 1) * size).limit(size)


def any_column_contains(columns: list[str], needle: str) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.lower(F.col(c).cast("string")).contains(needle.lower()), F.lit(False))
    return found


def suggestions(papers: DataFrame, needle: str, limit: int = 8) -> DataFrame:
    """The first papers by title that hold the needle in title, venue, year or DOI; a needle of under two characters finds none."""
    columns = [c for c in ("title", "venue", "year", "doi") if c in papers.columns]
    found = papers.where(any_column_contains(columns, needle.strip())) if len(needle.strip()) >= 2 else papers.limit(0)
    return found.orderBy("title", "paper_id").limit(limit)


def venues(papers: DataFrame) -> DataFrame:
    """(venue, n) in order of the venue's name in any case."""
    name = text.venue_name(F.col("venue"))
    return papers.groupBy(name.alias("venue")).agg(F.count("*").alias("n")).orderBy(F.lower("venue"), "venue")


def paper_line(title: Column, venue: Column, links: Column) -> Column:
    """One line of a page: title, venue, a full stop where none is, and links or a note that none is known."""
    shown = F.concat(title, F.when(F.coalesce(venue, F.lit("")) != "", F.concat(F.lit(" — "), venue)).otherwise(""))
    stop = F.when(shown.rlike(r"[.?!]$"), "").otherwise(".")
    return F.concat(F.lit("- "), shown, stop, F.lit(" "), F.when(F.size(links) > 0, F.array_join(links, " · ")).otherwise("Source link pending"))
