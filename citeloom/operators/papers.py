"""Paper records: merges of metadata sources, indexes by author and venue, and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text


def _filled(c: Column, kind: str) -> Column:
    """Null where a source has nothing: empty strings and empty arrays; 0 is something."""
    if kind == "string":
        return text.falsy_to_null(c)
    if kind.startswith("array"):
        return F.when(F.size(c) > 0, c)
    return c


def fill_gaps(sources: list[DataFrame], key: str = "paper_id") -> DataFrame:
    """One record a key from several sources: each column from the first source, then first record, that has it.

    Sources are unioned with their rank and reduced by one aggregate, whatever their number.
    """
    columns = [c for c in sources[0].columns if c not in (key, "ord")]
    kinds = dict(sources[0].dtypes)
    ranked = [s.select(key, F.struct(F.lit(k).alias("source"), F.col("ord").alias("ord")).alias("__rank"), *columns) for k, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, ranked).where(F.col(key).isNotNull())
    made = []
    for c in columns:
        value = _filled(F.col(c), kinds[c])
        made.append(F.min_by(value, F.when(value.isNotNull(), F.col("__rank"))).alias(c))
    return rows.groupBy(key).agg(*made)


def overlaid(papers: DataFrame, discovered: DataFrame, key: str = "paper_id") -> DataFrame:
    """The other merge: what the later source has, also empty strings, wins over the earlier one. The last record of each counts."""
    columns = [c for c in papers.columns if c not in (key, "ord")]
    last = lambda df: df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, "ord").alias(c) for c in columns])
    old, new = last(papers).alias("p"), last(discovered).alias("d")
    both = old.join(new, F.col(f"p.{key}") == F.col(f"d.{key}"), "full")
    return both.select(F.coalesce(f"p.{key}", f"d.{key}").alias(key), *[F.coalesce(f"d.{c}", f"p.{c}").alias(c) for c in columns])


def backfilled(papers: DataFrame, found: DataFrame, key: str = "paper_id") -> DataFrame:
    """papers with blank title, year and venue from `found`, and `changed`."""
    new = found.select(key, *[F.col(c).alias(f"__{c}") for c in ("title", "year", "venue")])
    joined = papers.join(new, key, "left")
    blank = lambda c: ~text.has_text(F.col(c)) if c != "year" else F.coalesce(F.col("year"), F.lit(0)) == 0
    has = lambda c: text.has_text(F.col(f"__{c}")) if c != "year" else F.coalesce(F.col("__year"), F.lit(0)) != 0
    take = {c: blank(c) & has(c) for c in ("title", "year", "venue")}
    made = {c: F.when(take[c], F.col(f"__{c}")).otherwise(F.col(c)) for c in take}
    columns = [made.get(c, F.col(c)).alias(c) for c in papers.columns]
    return joined.select(*columns, (take["title"] | take["year"] | take["venue"]).alias("changed"))


def with_abstracts(papers: DataFrame, abstracts: DataFrame, key: str = "paper_id") -> DataFrame:
    """papers with the first abstract of `abstracts` (ord) where their own is missing or empty."""
    first = abstracts.where(text.has_text(F.col("abstract"))).groupBy(key).agg(F.min_by("abstract", "ord").alias("__text"))
    own = F.coalesce(text.falsy_to_null(F.col("abstract")), "__text")
    return papers.join(first, key, "left").select(*[own.alias(c) if c == "abstract" else papers[c] for c in papers.columns])


def resolved_ids(wanted: DataFrame, ids: DataFrame) -> DataFrame:
    """(raw, kind, canonical): identifiers by shape, looked up in ids (kind, value, canonical) in the order tried.

    A kind that isn't recognised is null; a recognised identifier that isn't known has a null canonical id.
    """
    raw = F.trim("raw")
    low = F.lower(raw)
    after = F.regexp_extract(low, "^[^:]*:(.*)$", 1)
    kind = (
        F.when(low.startswith("doi:"), "doi")
        .when(low.startswith("arxiv:"), "arxiv")
        .when(low.rlike("^(pmc|pmcid):") | low.rlike("^pmc[0-9]+$"), "pmc")
        .when(low.rlike("^(pubmed|pmid):"), "pubmed")
        .when(low.startswith("s2:"), "s2")
        .when(low.startswith("10.") & low.contains("/"), "doi")
        .when(low.rlike(r"^w\d+$"), "openalex")
        .when(low.rlike(r"^\d{4}\.\d{4,5}(v\d+)?$"), "arxiv")
        .when(low.rlike("^[0-9a-f]{40}$"), "s2hash")
        .when(low.rlike(r"^\d+$"), "digits")
    )
    number = F.regexp_replace(F.when(low.contains(":"), after).otherwise(low), "^[pmc]+", "")
    bare = F.when(low.startswith("arxiv:"), after).otherwise(low)
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    tried = (
        F.when(kind == "doi", F.array(pair("doi", text.lookup_doi(raw))))
        .when(kind == "arxiv", F.array(pair("arxiv", bare), pair("doi", F.concat(F.lit("10.48550/arxiv."), bare))))
        .when(kind == "pmc", F.array(pair("pmc", number), pair("pmc", F.concat(F.lit("PMC"), number))))
        .when(kind == "pubmed", F.array(pair("pubmed", after)))
        .when(kind == "s2", F.array(pair("s2", F.substring(raw, F.lit(4), F.length(raw))), pair("s2hash", after)))
        .when(kind == "s2hash", F.array(pair("s2hash", low)))
        .when(kind == "digits", F.array(pair("s2", low), pair("pubmed", low)))
    )
    asked = wanted.select("raw", kind.alias("kind"), tried.alias("tried"))
    each = asked.select("raw", "kind", F.posexplode_outer("tried").alias("at", "t")).select("raw", "kind", "at", F.col("t.k").alias("id_kind"), F.col("t.v").alias("value"))
    known = ids.select(F.col("kind").alias("id_kind"), "value", "canonical")
    hits = each.join(known, ["id_kind", "value"], "left")
    return hits.groupBy("raw").agg(F.first("kind").alias("kind"), F.min_by("canonical", F.when(F.col("canonical").isNotNull(), F.col("at"))).alias("canonical"))


def paper_ids_by_name(side: DataFrame, inline: DataFrame, name: str) -> DataFrame:
    """(name, paper_id): a side file and the papers' own names, trimmed and in lower case, each pair once."""
    clean = F.lower(F.trim(name))
    rows = side.select("paper_id", F.col(name)).unionByName(inline.select("paper_id", F.col(name)))
    return rows.where(text.has_text(F.col(name)) & F.col("paper_id").isNotNull()).select(clean.alias("name"), "paper_id").distinct()


def duplicate_ids(df: DataFrame, key: str = "paper_id") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def quality_report(papers: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: duplicate ids, records without title, year or venue, records without provenance, broken edges."""
    last = papers.where("paper_id is not null").groupBy("paper_id").agg(F.max_by(F.struct("title", "year", "venue", "source", "fetched_at"), "ord").alias("x")).select("paper_id", "x.*")
    empty = (~text.has_text(F.col("title"))) | (F.coalesce("year", F.lit(0)) == 0) | (~text.has_text(F.col("venue")))
    state = last.agg(F.count_if(empty).alias("missing_metadata"), F.count_if(~text.has_text(F.col("source")) | ~text.has_text(F.col("fetched_at"))).alias("missing_provenance"))
    duplicates = duplicate_ids(papers).agg(F.count("*").alias("duplicate_ids"))
    return duplicates.crossJoin(state).crossJoin(broken_edges(edges, last).agg(F.count("*").alias("broken_edges")))  # one row each


def broken_edges(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Edges of which an end is null or no known paper, repeats included."""
    known = papers.select("paper_id").distinct()
    ends = edges.join(known.select(F.col("paper_id").alias("src"), F.lit(True).alias("__s")), "src", "left")
    ends = ends.join(known.select(F.col("paper_id").alias("dst"), F.lit(True).alias("__d")), "dst", "left")
    return ends.where("__s is null or __d is null").select(*edges.columns)


def titles_match(pairs: DataFrame, a: str, b: str) -> Column:
    """Equal keys, or one of more than 20 characters within the other. Both columns are normalised titles."""
    x, y = pairs[a], pairs[b]
    short, long = F.when(F.length(x) < F.length(y), x).otherwise(y), F.when(F.length(x) < F.length(y), y).otherwise(x)
    return (x != "") & (y != "") & ((x == y) | ((F.length(short) > 20) & (F.instr(long, short) > 0)))


def paper_records(papers: DataFrame, labels: DataFrame, corpus: DataFrame) -> DataFrame:
    """One record for every id that any of the three knows; title, year and venue of the corpus fill gaps."""
    side = corpus.select("paper_id", F.col("title").alias("__title"), F.col("year").alias("__year"), F.col("venue").alias("__venue"), "fulltext_file")
    tags = labels.select("paper_id", "category", F.col("tier").alias("category_tier"), F.col("confidence").alias("category_confidence"))
    joined = papers.join(tags, "paper_id", "full").join(side, "paper_id", "full")
    own = [c for c in papers.columns if c not in ("paper_id", "title", "year", "venue")]
    return joined.select(
        F.col("paper_id").alias("canonical_id"),
        F.coalesce(text.falsy_to_null(F.col("title")), "__title").alias("title"),
        F.coalesce(F.when(F.col("year") != 0, F.col("year")), "__year").alias("year"),
        F.coalesce(text.falsy_to_null(F.col("venue")), "__venue").alias("venue"),
        *own,
        "category",
        "category_tier",
        "category_confidence",
        text.has_text(F.col("fulltext_file")).alias("has_fulltext"),
    )
