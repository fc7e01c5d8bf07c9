"""The full-text corpus: documents, chunks, preferred versions and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.functions import documents as D
from citeloom.functions import text

from .graph import BROADCAST_ROWS, cut_lineage

#: Normalised titles of fewer characters don't make two documents one.
TITLE_KEY_CHARS = 30


def yearly_selection(index: DataFrame, files: DataFrame) -> DataFrame:
    """One record a file and one a paper, both compared in lower case; of equals the first (`ord`) stays.

    A DOI is better than another S2 id, then an exact file name, metadata, a title, and more characters.
    """
    paper = F.lower("paper_id")
    joined = index.where(text.has_text(paper)).join(files.select("path", F.lower("path").alias("__path")), F.lower("fulltext_file") == F.col("__path"))
    kind = F.when(paper.startswith("doi:"), 2).when(paper.startswith("s2:"), 1).otherwise(0)
    rank = F.struct(
        kind,
        (F.col("fulltext_file") == F.col("path")).cast("int"),
        F.coalesce("has_metadata", F.lit(False)).cast("int"),
        text.has_text(F.col("title")).cast("int"),
        F.coalesce("n_chars", F.lit(0)),
        -F.col("ord"),
    )
    row = F.struct(*[F.col(c) for c in index.columns], "path", "__path")
    files_ = joined.groupBy("__path").agg(F.max_by(row, rank).alias("x"), F.max(rank).alias("rank"))
    best = files_.groupBy(F.lower("x.paper_id").alias("__paper")).agg(F.max_by("x", "rank").alias("x"))
    return best.select("x.*").drop("__path")


def canonical_keys(docs: DataFrame) -> DataFrame:
    """docs (ord, text or its sha256, title, canonical_key) with the key of the first document of equal text, else of equal long title.

    Later documents take the key that the first of their kind registered. A title is registered by documents that are the
    first of their text, so a document that is first in neither of two overlapping groups follows its text.
    """
    digest = F.col("sha256") if "sha256" in docs.columns else F.sha2("text", 256)
    title = F.when(F.length(text.title_key(F.col("title"))) >= TITLE_KEY_CHARS, text.title_key(F.col("title")))
    named = docs.withColumn("sha256", digest).withColumn("__title", title)
    first = named.groupBy("sha256").agg(F.min_by(F.struct("ord", "canonical_key", "__title"), "ord").alias("f")).select("sha256", "f.*")
    titles = first.where("__title is not null").groupBy("__title").agg(F.min_by("canonical_key", "ord").alias("__by_title"))
    keys = first.join(titles, "__title", "left").select("sha256", F.coalesce("__by_title", "canonical_key").alias("__key"))
    return named.join(keys, "sha256").withColumn("canonical_key", F.col("__key")).drop("__key", "__title")


def preferred_versions(docs: DataFrame) -> DataFrame:
    """docs with `preferred`: the best version of each canonical key."""
    kind = F.when(F.col("paper_id").startswith("doi:"), 0).when(F.col("paper_id").startswith("s2:"), 1).otherwise(2)
    order = Window.partitionBy("canonical_key").orderBy(kind, F.desc("evidence_ready"), F.desc("quality_score"), F.desc("character_count"), "source_path")
    return docs.withColumn("preferred", F.row_number().over(order) == 1)


def chunked(docs: DataFrame) -> DataFrame:
    """(document_id, chunk_no, heading, line_start, line_end, text)."""
    return D.chunk_table(docs)


def build_documents(files: DataFrame, papers: DataFrame, labels: DataFrame, texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) of Markdown files (ord, source_path, origin, text) with metadata and labels by lower-cased paper id.

    A text is shuffled once at most, to its metadata: what is known of it goes on without it, and chunks are made of files as they are
    read. Documents get their texts back at the end, unless `texts` is false.
    """
    key, paper_id, converter = text.identity_from_path(F.col("source_path"))
    named = files.withColumn("canonical_key", key).withColumn("__paper", paper_id).withColumn("converter_source", converter)
    meta = papers.select(F.lower("paper_id").alias("__paper"), F.col("paper_id").alias("m_id"), F.col("title").alias("m_title"), "year", "venue", F.col("doi").alias("m_doi"), F.lit(True).alias("m"))
    # few titles go to the texts; else texts are shuffled, but not sorted
    joined = named.join(F.broadcast(meta) if meta.count() <= BROADCAST_ROWS else meta.hint("shuffle_hash"), "__paper", "left")
    stem = F.regexp_replace(F.element_at(F.split("source_path", "/"), -1), r"\.[^.]*$", "")
    titled = joined.withColumn("title", F.coalesce(text.falsy_to_null(F.col("m_title")), text.markdown_title(F.col("text"), stem)))
    known = {
        "evidence_status": text.evidence_status(F.col("text"), F.col("title"), F.col("origin")),
        "size_bytes": F.octet_length("text"),
        "character_count": F.length("text"),
        "sha256": F.sha2("text", 256),
        "__chunks": D.chunk_count("text"),
    }
    # written without the texts, which several joins would read and shuffle anew
    joined = cut_lineage(titled.withColumns(known).withColumn("quality_score", text.quality_score(F.col("text"), F.col("__chunks"))).drop("text"))
    joined = joined.withColumn("paper_id", F.lower(F.coalesce(text.falsy_to_null(F.col("m_id")), "__paper")))
    joined = joined.join(labels.select(F.lower("paper_id").alias("paper_id"), "category"), "paper_id", "left")
    doi = F.coalesce(text.falsy_to_null(F.col("m_doi")), F.when(F.col("paper_id").startswith("doi:"), F.regexp_replace("paper_id", "^doi:", "")), F.lit(""))
    docs = canonical_keys(joined).select(
        F.col("ord").alias("document_id"),
        "canonical_key",
        "paper_id",
        F.lower(doi).alias("doi"),
        "title",
        "year",
        F.coalesce("venue", F.lit("")).alias("venue"),
        F.coalesce("category", F.lit("")).alias("category"),
        "origin",
        "converter_source",
        "evidence_status",
        "source_path",
        "size_bytes",
        "character_count",
        "sha256",
        "quality_score",
        F.coalesce("m", F.lit(False)).alias("metadata_matched"),
    ).withColumn("evidence_ready", F.col("evidence_status") == "ready")
    docs = preferred_versions(docs)
    own = files.select(F.col("ord").alias("document_id"), "text")
    return docs.join(own, "document_id") if texts else docs, chunked(own)


def corpus_stats(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of counts."""
    counts = docs.agg(
        F.count("*").alias("documents"),
        F.count_if("preferred").alias("preferred_documents"),
        F.count_if(~F.col("preferred")).alias("duplicate_versions"),
        F.count_if("metadata_matched").alias("metadata_matches"),
        F.count_if(F.col("character_count") < 2000).alias("short_documents"),
        F.count_if("evidence_ready").alias("evidence_ready"),
        F.max("year").alias("newest_year"),
    )
    return counts.crossJoin(chunks.agg(F.count("*").alias("chunks")))  # one row each


def grouped_stats(docs: DataFrame) -> DataFrame:
    """(facet, value, n) for evidence status, origin and converter, and category of preferred versions, in one pass."""
    facets = F.array(
        F.struct(F.lit("evidence_status").alias("facet"), F.col("evidence_status").alias("value")),
        F.struct(F.lit("origin").alias("facet"), F.col("origin").alias("value")),
        F.struct(F.lit("converter_source").alias("facet"), F.col("converter_source").alias("value")),
        F.when(F.col("preferred"), F.struct(F.lit("category").alias("facet"), F.coalesce(text.falsy_to_null(F.col("category")), F.lit("unclassified")).alias("value"))),
    )
    return docs.select(F.explode(facets).alias("x")).where("x is not null").groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def latest_documents(docs: DataFrame, *, limit: int = 20, category: str | None = None, unknown_year: bool = False) -> DataFrame:
    kept = docs.where(F.col("preferred") & F.col("evidence_ready"))
    if category:
        kept = kept.where(F.col("category") == category)
    if not unknown_year:
        kept = kept.where("year is not null")
    return kept.orderBy(F.desc(F.coalesce("year", F.lit(0))), "title", "document_id").limit(limit)


def find_document(docs: DataFrame, selector: str) -> DataFrame:
    """By id, or by paper id or path in any case: the preferred one, then the best."""
    if selector.isdigit():
        return docs.where(F.col("document_id") == int(selector))
    low = selector.lower()
    found = docs.where((F.lower("paper_id") == low) | (F.lower("source_path") == low))
    return found.orderBy(F.desc("preferred"), F.desc("quality_score"), "document_id").limit(1)


def read_lines(docs: DataFrame, start: int = 1, end: int | None = None, text_column: str = "text") -> DataFrame:
    """(document_id, line_no, line) of a range of lines, numbered from 1; any line ending ends a line."""
    # a last line ending doesn't begin another line
    lines = F.split(F.regexp_replace(text_column, "(\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\u0085  ])\\z", ""), "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\u0085  ]", -1)
    numbered = docs.where(F.length(text_column) > 0).select("document_id", F.posexplode(lines).alias("at", "line"))
    wanted = F.col("at") >= max(start, 1) - 1
    if end is not None:
        wanted = wanted & (F.col("at") < end)
    return numbered.where(wanted).select("document_id", (F.col("at") + 1).alias("line_no"), "line")
