"""Secret scans over an incremental ledger of content-addressed texts, in DataFrame functions only.

Every version of every path has a blob, named by the SHA-256 of its text. The ledger holds the pairs (blob, rule_version)
that were scanned, with their findings, clean blobs included. A scan takes one text per distinct blob, leaves out the pairs
that the ledger has, searches the others, appends them to the ledger, and joins the ledger's findings back to all paths. The
ledger is a table in a folder: a later scan of more versions reads it and searches new blobs only, and a new rule version
searches all again. Without a folder of its own a scan keeps its ledger in the shared folder.

A rule is a pattern, the group whose length counts, and the least length. Matches are leftmost and do not overlap within a
rule, and a match that is too short is dropped after it has been taken. The text between the matches (`split`) and the
matches (`regexp_extract_all`) give the positions, in code points, end exclusive. No Python runs on the executors.

Defined cases: a null text is the empty one and has no findings; repeated rows are repeated in the result; a null path
stays null; empty tables give no rows; other columns are ignored; spans of two rules may overlap and are all reported.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.graph import folder_exists, scratch

from .common import checkpointed, spread_join, table


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int
    least: int


#: Fixed by the contract, in this order.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Well-known formats that the base rules miss.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2024-1"
#: Matches of a text whose spans are gathered together.
PIECE = 256
#: Rows of a broadcast, at most; beyond it the texts are shuffled.
SKIPPED_ROWS = 500_000

LEDGER = "blob string, rule_version string, spans array<struct<start:int,rank:int,end:int>>"
SPAN = "struct<start:int,rank:int,end:int>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start,rank,end>> of one rule."""
    pattern = F.lit(rule.pattern)
    parts = F.zip_with(
        F.split(text, rule.pattern, -1),
        F.zip_with(
            F.regexp_extract_all(text, pattern, F.lit(0)),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)),
            lambda whole, value: F.struct(F.length(whole).alias("length"), F.length(value).alias("value")),
        ),
        lambda before, match: F.struct(F.length(before).alias("before"), match.length.alias("length"), match.value.alias("value")),
    )  # the piece after the last match has no match

    def step(state: Column, part: Column) -> Column:
        begin = state.at + part.before
        end = begin + F.coalesce(part.length, F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        found = F.when(part.value >= rule.least, F.concat(state.found, F.array(span))).otherwise(state.found)
        return F.struct(end.alias("at"), found.alias("found"))

    def within(piece: Column, offset: Column) -> Column:
        start = F.struct(offset.alias("at"), F.expr(NO_SPANS).alias("found"))
        return F.aggregate(piece, start, step, lambda state: state.found)

    def offsets(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda piece: F.aggregate(piece, F.lit(0), lambda n, part: n + part.before + F.coalesce(part.length, F.lit(0))))
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("all"))
        more = lambda state, n: F.struct((state.at + n).alias("at"), F.concat(state.all, F.array(state.at)).alias("all"))
        return F.aggregate(sizes, start, more, lambda state: state.all)

    # an array that grows is copied with each match, so the parts go in pieces; the array of pieces is short
    cut = lambda parts: F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / PIECE).cast("int")), lambda k: F.slice(parts, k * PIECE + 1, F.lit(PIECE)))
    spans = _let(parts, lambda parts: _let(cut(parts), lambda pieces: F.flatten(F.zip_with(pieces, offsets(pieces), within))))
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.expr(NO_SPANS))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def unseen_texts(
    versions: DataFrame, ledger: DataFrame | None, *, path: str = "doc_id", text: str = "text", rule_version: str = RULE_VERSION
) -> DataFrame:
    """(blob, text) of the blobs that the ledger doesn't have under this rule version, from the smallest path of each.

    Which rows to leave out is found without their texts. Up to SKIPPED_ROWS of them are broadcast, and no text moves;
    beyond that the texts are joined by a shuffle. Equal rows may both be scanned.
    """
    named = checkpointed(versions.select(versions[path].alias("path"), blob_of(versions[text]).alias("blob")))
    first = named.groupBy("blob").agg(F.min("path").alias("first"), F.count("*").alias("copies"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version).select("blob", F.lit(True).alias("seen")).distinct()
        first = first.join(seen, "blob", "left")
    else:
        first = first.withColumn("seen", F.lit(None).cast("boolean"))
    part = F.conv(F.substring("blob", 1, 15), 16, 10).cast("long").alias("part")
    known = spread_join(named, checkpointed(first.where("copies > 1 or seen").drop("copies")), "blob")
    # a blob that is neither repeated nor seen has no row in the lookup
    other = F.col("seen") | (F.col("first").isNotNull() & ~F.col("path").eqNullSafe(F.col("first")))
    skip = checkpointed(known.where(other).select("path", part).distinct())
    if skip.count() <= SKIPPED_ROWS:
        skip = F.broadcast(skip)
    rows = versions.select(versions[path].alias("path"), F.coalesce(versions[text], F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    mine = rows.select("path", "blob", "text", part)
    return mine.join(skip, mine["path"].eqNullSafe(skip["path"]) & (mine["part"] == skip["part"]), "left_anti").select("blob", "text")


def scan_ledger(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    *,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """New rows of the ledger: (blob, rule_version, spans), also for blobs without a finding, so none is scanned twice.

    Spans are ordered by start, then rule.
    """
    blobs = unseen_texts(versions, ledger, path=path, text=text, rule_version=rule_version)
    value = F.col("text")
    likely = F.lit(False)
    for rule in rules:
        likely = likely | value.rlike(rule.pattern)
    found = F.array_sort(F.concat(*[_spans(value, rule, rank) for rank, rule in enumerate(rules)]))
    spans = F.when(likely, found).otherwise(F.expr(NO_SPANS))
    return blobs.select("blob", F.lit(rule_version).alias("rule_version"), spans.alias("spans")).dropDuplicates(["blob"])


def scanned(versions: DataFrame, folder: str | None = None, **more) -> DataFrame:
    """The ledger in the folder after all blobs of the versions were scanned that it lacked. A new folder has no ledger yet."""
    spark = versions.sparkSession
    ledger = spark.read.schema(LEDGER).parquet(folder) if folder and folder_exists(spark, folder) else None
    folder = folder or scratch(spark, "ledger")
    scan_ledger(versions, ledger, **more).write.mode("append").parquet(folder)
    return spark.read.schema(LEDGER).parquet(folder)


def findings_of(versions: DataFrame, ledger: DataFrame, *, keep: list[str], text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Columns `keep` of every version with blob and spans from the ledger."""
    named = checkpointed(versions.select(*[versions[c] for c in keep], blob_of(versions[text]).alias("blob")))
    return _with_spans(named, ledger, rule_version).withColumn("spans", F.coalesce("spans", F.expr(NO_SPANS)))


def _with_spans(named: DataFrame, ledger: DataFrame, rule_version: str) -> DataFrame:
    """Rows with a blob, with its spans from the ledger, or null without any."""
    known = checkpointed(ledger.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans").dropDuplicates(["blob"]))
    n, spans = known.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    if n + spans <= SKIPPED_ROWS:
        return named.join(F.broadcast(known), "blob", "left")
    return spread_join(named, known, "blob")


def as_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s.start.cast("string"), s.end.cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every run of covered characters replaced. Spans are ordered by start."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.concat(state.out, F.substring(text, state.at + 1, span.start - state.at), F.lit(mask))
        return F.struct(
            F.greatest(state.at, span.end).alias("at"), F.when((span.start >= state.at) & ((state.at == 0) | (span.start > state.at)), fresh).otherwise(state.out).alias("out")
        )

    end = F.lit(2**31 - 1)
    return F.aggregate(spans, start, step, lambda state: F.concat(state.out, F.substring(text, state.at + 1, end)))


def redact(docs: DataFrame, *, path: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """docs with secrets masked; columns stay as they are. Only texts with findings change. The folder is the ledger's."""
    names = docs.columns
    plain = docs.toDF(*[f"__{k}" for k in range(len(names))])
    own_path, own = (f"__{names.index(c)}" for c in (path, text))
    ledger = scanned(plain, folder, path=own_path, text=own)
    joined = _with_spans(plain.withColumn("blob", blob_of(F.col(own))), ledger, RULE_VERSION)
    clean = F.when(F.col("spans").isNull(), F.col(own)).otherwise(redacted(F.col(own), F.col("spans")))
    return joined.withColumn(own, clean).select(*plain.columns).toDF(*names)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_RULES))
    count = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
    return findings_of(documents, scanned(documents), keep=["doc_id"]).select(
        "doc_id",
        *[count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(BASE_RULES)],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(spans).alias("spans"),
    )


def _sql_spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS k, '{kind}' AS kind, p + CAST(coalesce(list_sum(list_transform(befores[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s, len(wholes[i]) AS n
  FROM (SELECT doc_id, 0 AS p, string_split_regex(text, '{quoted}') AS befores, regexp_extract_all(text, '{quoted}', 0) AS wholes, regexp_extract_all(text, '{quoted}', {group}) AS vals FROM t), unnest(range(1, len(wholes) + 1)) AS u(i)
  WHERE len(vals[i]) >= {least}"""


_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
OP5_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_sql_spans(k, r.kind, _ASSIGN if k == 0 else r.pattern, r.group, r.least) for k, r in enumerate(RULES))}),
g AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k) AS spans
  FROM f GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
"""
