"""Pages of the paper catalog as rows of lines, so a page of any length is never held in one row or on the driver.

Every paper stands on four pages: that of its category, year, venue group and best source link. A line has a place; lines in
order of page and place are the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import fixed, text

from .catalog import paper_line, source_groups, venue_buckets, year_pivot

_VENUE_GROUPS = [*"abcdefghijklmnopqrstuvwxyz", *fixed.VENUE_GROUPS]


def _named(key: Column, names: dict[str, str], otherwise: Column | None = None) -> Column:
    found = F.lit(None).cast("string") if otherwise is None else otherwise
    for value, name in names.items():
        found = F.when(key == value, name).otherwise(found)
    return found


def _group_name(bucket: Column) -> Column:
    return _named(bucket, fixed.VENUE_GROUPS, F.upper(bucket))


def _count(n: Column) -> Column:
    return F.format_number(n, 0)


def placed(papers: DataFrame) -> DataFrame:
    """(view, page, section, section_rank, paper columns): papers with `links` on their four pages."""
    categories = list(fixed.CATEGORY_HEADINGS)
    year = F.coalesce(F.col("year").cast("string"), F.lit("Year unknown"))
    newest = F.coalesce(-F.col("year"), F.lit(2**31 - 1)).cast("int")
    venue = text.venue_name(F.col("venue"))
    group = text.links_group(F.col("links"))
    rank = _named(F.col("category"), {c: str(k) for k, c in enumerate(categories)}).cast("int")
    none = F.lit("")
    views = [
        ("category", F.concat("category", F.lit(".md")), year, newest, none),
        ("year", F.concat(F.lit("by_year/"), F.coalesce(F.col("year").cast("string"), F.lit("unknown")), F.lit(".md")), _named(F.col("category"), fixed.CATEGORY_HEADINGS), rank, none),
        ("venue", F.concat(F.lit("by_venue/"), text.venue_bucket(venue), F.lit(".md")), venue, F.lit(0), F.lower(venue)),
        ("source", F.concat(F.lit("by_source/"), _named(group, fixed.SOURCE_PAGES), F.lit(".md")), year, newest, none),
    ]
    each = F.array(*[F.struct(F.lit(v).alias("view"), p.alias("page"), s.alias("section"), r.alias("number"), w.alias("word")) for v, p, s, r, w in views])
    return papers.where(F.col("category").isin(categories)).select("*", F.explode(each).alias("x")).select(*papers.columns, "x.*")


def _place(section: int, number: Column, word: Column, entry: int, *last: Column) -> Column:
    order = last or (F.lit(0), F.lit(""), F.lit(""))
    return F.struct(
        F.lit(section).alias("part"), number.cast("int").alias("number"), word.alias("word"), F.lit(entry).alias("entry"),
        order[0].cast("int").alias("newest"), order[1].alias("title"), order[2].alias("paper_id"),
    )


def page_lines(papers: DataFrame) -> DataFrame:
    """(page, place, line) of the pages of categories, years, venue groups and sources.

    Papers have paper_id, title, year, venue, category, links, and shown_title and shown_venue as they stand in Markdown.
    """
    rows = placed(papers)
    zero, none = F.lit(0), F.lit("")
    venue = F.when(F.col("view") != "venue", F.col("shown_venue")).otherwise("")
    order = (F.coalesce(-F.col("year"), F.lit(2**31 - 1)), F.lower("title"), F.col("paper_id"))
    entries = rows.select("page", _place(1, F.col("number"), F.col("word"), 1, *order).alias("place"), paper_line(F.col("shown_title"), venue, F.col("links")).alias("line"))
    parts = rows.groupBy("view", "page", "section", "number", "word").agg(F.count("*").alias("n"), F.min("shown_venue").alias("shown"))
    title = F.when(F.col("view") == "venue", F.coalesce(text.falsy_to_null(F.col("shown")), F.col("section"))).otherwise(F.col("section"))
    counted = F.when(F.col("view").isin("year", "venue"), F.concat(F.lit(" ("), _count(F.col("n")), F.lit(")"))).otherwise("")
    headings = parts.select("page", _place(1, F.col("number"), F.col("word"), 0).alias("place"), F.concat(F.lit("## "), title, counted).alias("line"))
    pages = parts.groupBy("view", "page").agg(F.sum("n").alias("n"), F.count("*").alias("sections"))
    stem = F.regexp_extract("page", r"([^/]+)\.md$", 1)
    named = (
        F.when(F.col("view") == "category", _named(stem, fixed.CATEGORY_HEADINGS))
        .when(F.col("view") == "year", F.when(stem == "unknown", "Year unknown").otherwise(stem))
        .when(F.col("view") == "venue", F.concat(F.lit("Publication venues: "), _group_name(stem)))
        .otherwise(F.concat(F.lit("Source: "), _named(stem, {p: fixed.SOURCE_GROUPS[g] for g, p in fixed.SOURCE_PAGES.items()})))
    )
    back = F.when(F.col("view") == "category", "[Catalog](README.md)").otherwise("[Groups](README.md) · [Catalog](../README.md)")
    venues = F.when(F.col("view") == "venue", F.concat(_count(F.col("sections")), F.lit(" venues, "))).otherwise("")
    top = F.array(F.concat(F.lit("# "), named), back, F.concat(venues, _count(F.col("n")), F.lit(" papers")))
    heads = pages.select("page", F.posexplode(top).alias("k", "line")).select("page", _place(0, F.col("k"), none, 0).alias("place"), "line")
    return heads.unionByName(headings).unionByName(entries)


def index_lines(papers: DataFrame) -> DataFrame:
    """(page, place, line) of the catalog's first page and of the lists of years, venue groups and sources."""
    spark = papers.sparkSession
    categories = list(fixed.CATEGORY_HEADINGS)
    kept = papers.where(F.col("category").isin(categories))
    group = text.links_group(F.col("links"))
    known = spark.createDataFrame([(c, k) for k, c in enumerate(categories)], "category string, k int")
    by_category = known.join(kept.groupBy("category").agg(F.count("*").alias("n")), "category", "left").na.fill(0, ["n"])
    cells = lambda *cs: F.concat(F.lit("| "), F.concat_ws(" | ", *cs), F.lit(" |"))
    link = lambda name, page: F.concat(F.lit("["), name, F.lit("]("), page, F.lit(")"))
    rows = by_category.select(F.lit("README.md").alias("page"), _place(1, F.col("k"), F.lit(""), 0).alias("place"), cells(link(_named(F.col("category"), fixed.CATEGORY_HEADINGS), F.concat("category", F.lit(".md"))), _count(F.col("n"))).alias("line"))
    years = year_pivot(kept, categories)
    year = F.col("year").cast("string")
    named = link(F.coalesce(year, F.lit("Unknown")), F.concat(F.coalesce(year, F.lit("unknown")), F.lit(".md")))
    newest = F.coalesce(-F.col("year"), F.lit(2**31 - 1))
    rows = rows.unionByName(years.select(F.lit("by_year/README.md").alias("page"), _place(1, newest, F.lit(""), 0).alias("place"), cells(named, _count(F.col("n_all")), *[_count(F.col(c)) for c in categories]).alias("line")))
    rank = F.array_position(F.array(*map(F.lit, _VENUE_GROUPS)), F.col("bucket"))
    venues = venue_buckets(kept)
    rows = rows.unionByName(venues.select(F.lit("by_venue/README.md").alias("page"), _place(1, rank, F.lit(""), 0).alias("place"), cells(link(_group_name(F.col("bucket")), F.concat("bucket", F.lit(".md"))), _count(F.col("venues")), _count(F.col("papers"))).alias("line")))
    names = list(fixed.SOURCE_GROUPS)
    sources = source_groups(kept, names, group)
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("source"))
    page = F.concat(_named(F.col("source"), fixed.SOURCE_PAGES), F.lit(".md"))
    rows = rows.unionByName(sources.select(F.lit("by_source/README.md").alias("page"), _place(1, rank, F.lit(""), 0).alias("place"), cells(link(_named(F.col("source"), fixed.SOURCE_GROUPS), page), _count(F.col("n"))).alias("line")))
    heads = {
        "README.md": ["# Paper catalog", "[Years](by_year/README.md) · [Venues](by_venue/README.md) · [Sources](by_source/README.md)", "| Category | Papers |", "|---|---:|"],
        "by_year/README.md": ["# Papers by year", "[Catalog](../README.md)", "| Year | All | " + " | ".join(fixed.CATEGORY_HEADINGS.values()) + " |", "|---|---:" + "|---:" * len(categories) + "|"],
        "by_venue/README.md": ["# Papers by venue", "[Catalog](../README.md)", "| Group | Venues | Papers |", "|---|---:|---:|"],
        "by_source/README.md": ["# Papers by source link", "[Catalog](../README.md)", "| Source | Papers |", "|---|---:|"],
    }
    top = spark.createDataFrame([(p, k, line) for p, lines in heads.items() for k, line in enumerate(lines)], "page string, k int, line string")
    return top.select("page", _place(0, F.col("k"), F.lit(""), 0).alias("place"), "line").unionByName(rows)
