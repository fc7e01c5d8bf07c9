"""Readers of record logs, tables and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

AUTHORS = "array<struct<name:string,authorId:string>>"
PAPERS = "paper_id string, title string, year string, venue string, authors string, doi string, corpusId string, openalex_id string, externalIds map<string,string>, external_ids map<string,string>, abstract string, citation_count string, citationCount string, open_access_pdf string, openAccessPdf string, s2_paper_id string, paperId string, arxiv_id string, source string, seed_tag string, provenance struct<source:string,fetched_at:string,confidence:double>"
CITATIONS = "`from` string, `to` string, relation string, source string, fetched_at string"
LABELS = "paper_id string, category string, is_core boolean, confidence string, reasoning string, classified_at string, model string, tier string"
ALIASES = "alias string, canonical string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern has a file, asked of its own file system."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def read_log(spark: SparkSession, path: str, schema: str, *, strict: bool = True) -> DataFrame:
    """Rows of a line-delimited JSON log with `ord`, their order in it; a missing file has none.

    strict fails on a malformed line; otherwise it is left out, as a torn last line of a log being written must be.
    """
    declared = T._parse_datatype_string(schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], declared).withColumn("ord", F.lit(0).cast("long"))
    reader = spark.read.schema(declared if strict else declared.add("_corrupt_record", "string"))
    rows = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    rows = _in_file_order(rows)
    return rows if strict else rows.where("_corrupt_record is null").drop("_corrupt_record")


def _in_file_order(rows: DataFrame, name: str | None = None) -> DataFrame:
    """rows with `ord` (and `file`, if the column of its name is given): files in order of name, blocks in order of place, rows in order within.

    Tasks read files packed by size, so their numbers alone don't tell. A block is read by one task in order; blocks, a row
    each, are ranked, and `ord` is the rank above the row's number in its task.
    """
    columns = [F.col(c) for c in rows.columns] + ([F.col(name).alias("file")] if name else [])
    numbered = rows.select(*columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id"))
    blocks = numbered.select("__path", "__start").distinct()
    ranked = blocks.withColumn("__rank", F.row_number().over(Window.orderBy("__path", "__start")) - 1)  # as many rows as blocks
    placed = numbered.join(ranked, ["__path", "__start"])
    row = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*rows.columns, *(["file"] if name else []), F.shiftleft(F.col("__rank").cast("long"), 33).bitwiseOR(row).alias("ord"))


def normalize_papers(rows: DataFrame) -> DataFrame:
    """One shape for the spellings that producers use; polymorphic fields arrive as JSON text."""
    ids = F.coalesce("external_ids", "externalIds", F.create_map().cast("map<string,string>"))
    filled = lambda *cs: F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in cs])
    named = F.from_json("authors", AUTHORS)
    plain = F.transform(F.from_json("authors", "array<string>"), lambda a: F.struct(a.alias("name"), F.lit(None).cast("string").alias("authorId")))
    authors = F.when(F.col("authors").rlike(r"^\s*\[\s*\{"), named).when(F.col("authors").rlike(r'^\s*\[\s*"'), plain)
    oa = filled("open_access_pdf", "openAccessPdf")
    return rows.where(F.col("paper_id") != "").select(
        "paper_id",
        "title",
        F.expr("try_cast(year as int)").alias("year"),
        "venue",
        F.filter(F.coalesce(authors, F.array().cast(AUTHORS)), lambda a: F.trim(a.getField("name")) != "").alias("authors"),
        "abstract",
        F.expr("try_cast(coalesce(citation_count, citationCount) as int)").alias("citation_count"),
        F.coalesce(ids["DOI"], filled("doi")).alias("doi"),
        F.coalesce(ids["ArXiv"], filled("arxiv_id")).alias("arxiv"),
        F.coalesce(ids["CorpusId"], filled("corpusId")).alias("s2"),
        ids["PubMedCentral"].alias("pmc"),
        ids["PubMed"].alias("pubmed"),
        filled("s2_paper_id", "paperId").alias("s2hash"),
        filled("openalex_id").alias("openalex"),
        F.get_json_object(oa, "$.url").alias("open_access_pdf_url"),
        "provenance",
        "ord",
    )


def read_papers(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """normalize_papers() of a log, with one parse a line: a line is a VARIANT whose fields are taken by their kind.

    Authors may be objects, texts, or both in one array; ids and numbers may be numbers or texts.
    """
    if not path_exists(spark, path):
        return normalize_papers(read_log(spark, path, PAPERS))
    lines = _in_file_order(spark.read.text(path)).where("trim(value) <> ''")
    rows = lines.select((F.parse_json("value") if strict else F.try_parse_json("value")).alias("v"), "ord")
    return papers_of(rows if strict else rows.where(F.schema_of_variant("v").startswith("OBJECT")))


def papers_of(rows: DataFrame) -> DataFrame:
    """The columns of normalize_papers() of rows (v, ord), where v is a VARIANT."""
    get = lambda path, kind="string": F.try_variant_get("v", path, kind)
    filled = lambda *paths: F.coalesce(*[F.nullif(get(p), F.lit("")) for p in paths])
    ids = F.coalesce(get("$.external_ids", "map<string,string>"), get("$.externalIds", "map<string,string>"), F.create_map().cast("map<string,string>"))
    author = lambda a: F.when(
        F.schema_of_variant(a).startswith("OBJECT"), F.struct(F.try_variant_get(a, "$.name", "string").alias("name"), F.try_variant_get(a, "$.authorId", "string").alias("authorId"))
    ).otherwise(F.struct(F.try_variant_get(a, "$", "string").alias("name"), F.lit(None).cast("string").alias("authorId")))
    authors = F.transform(get("$.authors", "array<variant>"), author)
    number = lambda c: c.try_cast("int")
    made = rows.where(get("$.paper_id") != "").select(
        get("$.paper_id").alias("paper_id"),
        get("$.title").alias("title"),
        number(get("$.year")).alias("year"),
        get("$.venue").alias("venue"),
        F.filter(F.coalesce(authors, F.array().cast(AUTHORS)), lambda a: F.trim(a.getField("name")) != "").alias("authors"),
        get("$.abstract").alias("abstract"),
        number(F.coalesce(get("$.citation_count"), get("$.citationCount"))).alias("citation_count"),
        F.coalesce(ids["DOI"], filled("$.doi")).alias("doi"),
        F.coalesce(ids["ArXiv"], filled("$.arxiv_id")).alias("arxiv"),
        F.coalesce(ids["CorpusId"], filled("$.corpusId")).alias("s2"),
        ids["PubMedCentral"].alias("pmc"),
        ids["PubMed"].alias("pubmed"),
        filled("$.s2_paper_id", "$.paperId").alias("s2hash"),
        filled("$.openalex_id").alias("openalex"),
        F.coalesce(get("$.open_access_pdf.url"), get("$.openAccessPdf.url")).alias("open_access_pdf_url"),
        get("$.provenance", "struct<source:string,fetched_at:string,confidence:double>").alias("provenance"),
        "ord",
    )
    return made


def json_field(column: str, path: str, kind: str = "string") -> Column:
    """A field of JSON texts; null where the text isn't JSON, has no such field, or the field is of another kind."""
    return F.get_json_object(column, path).try_cast(kind)


def read_batches(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, paper_id, title, abstract, ord) of JSON-array batch files, in order of their names and of the rows within."""
    schema = "paper_id string, title string, abstract string"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], "file string, " + schema + ", ord long")
    rows = _in_file_order(spark.read.schema(schema).option("multiLine", True).json(pattern), "_metadata.file_name")
    return rows.select("file", "paper_id", "title", "abstract", "ord")


def read_graph_csv(spark: SparkSession, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """Release tables; empty cells are null."""
    n = "paper_id string, title string, year int, venue string, category string, doi string, arxiv string, pubmed string, pmc string, citation_count int"
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "DROPMALFORMED"}
    return spark.read.options(**options).schema(n).csv(nodes), spark.read.options(**options).schema("source string, target string, relation string").csv(edges)


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(source_path, text) of all *.md files below a folder; bytes that aren't UTF-8 are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(folder)
    inside = F.regexp_replace(F.col("path"), "^.*?" + folder.rstrip("/").rpartition("/")[2].replace(".", r"\.") + "/", "")
    return files.select(inside.alias("source_path"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def answers_in_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """(paper_id, category, ...) of classifier answers in texts: a JSON array, or else lines that are JSON objects."""
    row = "struct<paper_id:string,id:string,category:string,confidence:string,reasoning:string,model:string,tier:int>"
    block = F.regexp_extract(column, r"\[[\s\S]*?\]", 0)
    whole = F.from_json(block, f"array<{row}>")
    each = F.filter(F.transform(F.split(column, "\n"), lambda x: F.when(F.trim(x).startswith("{"), F.from_json(F.trim(x), row))), lambda x: x.isNotNull())
    # an array whose objects hold arrays isn't read by the short match, and lines are tried
    usable = F.coalesce(F.exists(whole, lambda x: x.category.isNotNull()), F.lit(False))
    return lines.select(F.explode(F.when(usable, whole).otherwise(each)).alias("x")).select("x.*")


def answers_in_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """(paper_id, category) of agent logs: bare objects, and those in a message's content split at a literal backslash-n."""
    row = "struct<paper_id:string,category:string>"
    own = F.from_json(column, row)
    content = F.split(F.coalesce(F.get_json_object(column, "$.message.content"), F.lit("")), r"\\n|\n")
    inner = F.transform(F.filter(content, lambda x: F.trim(x).startswith("{")), lambda x: F.from_json(F.trim(x), row))
    found = lines.select(F.explode(F.concat(F.array(own), inner)).alias("x")).select("x.*")
    return found.where("paper_id is not null and category is not null")
