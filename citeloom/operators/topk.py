"""Best hits by block bounds: what can't reach the k-th score isn't read.

Chunks are dealt to spans of `SPAN` in the order of their ids. An index holds a block for each word and span: the span's
postings of the word, and the most that one of them can add to a score. For a query the bounds of its words give each span the
most that a chunk of it can score, and whether one of it can match at all: a span without a word that the query requires is
left out whatever its other words. The `FIRST` spans of the largest bounds are read; their k-th hit is a floor, and of all
other spans only those are read whose bound is the floor or more. So all hits and scores are those of scoring every match.

Queries of phrases, beginnings of words or nearness need positions, not counts, and are for `search.bm25`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import cut_lineage
from .labels import numbered
from .search import K1, LEAST_IDF, WEIGHTS, B, Both, Phrase, phrases_of, scored_phrases

SPAN = 256
FIRST = 32
_COLUMNS = range(len(WEIGHTS))


@dataclass
class Blocks:
    """A written index: blocks (term, span, best, postings), masks (term, columns, n), and the sizes of the whole."""

    blocks: DataFrame
    masks: DataFrame
    chunks: int
    mean: float


def gain(f: Column, words: Column, mean: float, idf: Column | None = None) -> Column:
    """What a word adds to a score, times its idf if given: multiplied in the order of search.bm25(), as ties show the last digit."""
    return (f if idf is None else idf * f) * (K1 + 1) / (f + K1 * (1 - B + B * words / F.lit(mean)))


def built(index: DataFrame, lengths: DataFrame, folder: str | None = None, span: int = SPAN) -> Blocks:
    """The blocks of postings (chunk_id, col, term, pos) and lengths (chunk_id, words), written to a folder if one is given.

    A block has `span` postings at most, so no word is a large row, however common it is.
    """
    chunks, mean = lengths.agg(F.count("*"), F.coalesce(F.avg("words"), F.lit(0.0))).first()
    spans = numbered(lengths.select("chunk_id", "words"), [F.col("chunk_id")]).select("chunk_id", "words", F.expr(f"place div {span}").alias("span"))
    counts = index.groupBy("term", "chunk_id").agg(*[F.count_if(F.col("col") == c).cast("int").alias(f"c{c}") for c in _COLUMNS])
    rows = cut_lineage(counts.join(spans, "chunk_id"))
    f = reduce(lambda a, c: a + c, [F.col(f"c{c}") * w for c, w in enumerate(WEIGHTS)])
    posting = F.struct("chunk_id", "words", *[f"c{c}" for c in _COLUMNS])
    blocks = rows.groupBy("term", "span").agg(F.max(gain(f, F.col("words"), mean)).alias("best"), F.collect_list(posting).alias("postings"))
    columns = reduce(lambda a, c: a + c, [F.when(F.col(f"c{c}") > 0, 1 << c).otherwise(0) for c in _COLUMNS])
    masks = rows.groupBy("term", columns.alias("columns")).agg(F.count("*").alias("n"))
    if folder is None:
        return Blocks(cut_lineage(blocks), cut_lineage(masks), chunks, mean)
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks.repartitionByRange(width, "term", "span").sortWithinPartitions("term", "span").write.mode("overwrite").parquet(f"{folder}/blocks")
    masks.repartitionByRange(width, "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/masks")
    rows.sparkSession.createDataFrame([(chunks, mean)], "chunks long, mean double").coalesce(1).write.mode("overwrite").parquet(f"{folder}/sizes")
    return opened(rows.sparkSession, folder)


def opened(spark: SparkSession, folder: str) -> Blocks:
    chunks, mean = spark.read.parquet(f"{folder}/sizes").first()
    return Blocks(spark.read.parquet(f"{folder}/blocks"), spark.read.parquet(f"{folder}/masks"), chunks, mean)


def countable(node) -> bool:
    """Whether counts answer the query: single whole words, in any columns, with AND, OR and NOT."""
    if isinstance(node, Both):
        return countable(node.left) and countable(node.right)
    return isinstance(node, Phrase) and len(node.terms) == 1 and not node.prefix and not node.first


def _holds(node, present: dict[Phrase, Column], maybe: bool) -> Column:
    """Whether a chunk matches; or, for a span, whether one of its chunks may: what NOT excludes is no reason against that."""
    if isinstance(node, Phrase):
        return present[node]
    left, right = _holds(node.left, present, maybe), _holds(node.right, present, maybe)
    if node.kind == "NOT":
        return left if maybe else left & ~right
    return left & right if node.kind == "AND" else left | right


class Query:
    def __init__(self, index: Blocks, node) -> None:
        if not countable(node):
            raise ValueError("phrases, beginnings and nearness need positions")
        self.index, self.node = index, node
        self.phrases = list(dict.fromkeys(phrases_of(node)))
        self.terms = sorted({p.terms[0] for p in self.phrases})
        masks = index.masks.where(F.col("term").isin(*self.terms)).collect()  # 2 ** columns rows a word
        self.idf: dict[Phrase, Column] = {}
        for p in self.phrases:
            wanted = sum(1 << c for c in (_COLUMNS if p.columns is None else p.columns))
            n = sum(r["n"] for r in masks if r["term"] == p.terms[0] and r["columns"] & wanted)
            idf = F.log((F.lit(index.chunks) - F.lit(n) + 0.5) / (F.lit(n) + 0.5))
            self.idf[p] = F.when(idf <= 0, LEAST_IDF).otherwise(idf)

    def blocks(self) -> DataFrame:
        return self.index.blocks.where(F.col("term").isin(*self.terms))

    def bounds(self) -> DataFrame:
        """(span, bound) of the spans that may hold a match."""
        best = {t: F.max(F.when(F.col("term") == t, F.col("best"))) for t in self.terms}
        rows = self.blocks().groupBy("span").agg(*[best[t].alias(f"b{k}") for k, t in enumerate(self.terms)])
        of = {p: F.col(f"b{self.terms.index(p.terms[0])}") for p in self.phrases}
        bound = reduce(lambda a, c: a + c, [F.coalesce(self.idf[p] * of[p], F.lit(0.0)) for p, _ in scored_phrases(self.node)])
        # the last digits of sums depend on their order
        return rows.where(_holds(self.node, {p: c.isNotNull() for p, c in of.items()}, True)).select("span", (bound * (1 + 1e-12)).alias("bound"))

    def scores(self, spans: DataFrame) -> DataFrame:
        """(chunk_id, score) of the matches in spans."""
        near = self.blocks().join(spans.select("span"), "span", "left_semi")
        rows = near.select("term", F.explode("postings").alias("p")).select("term", "p.*")
        f = {}
        for p in self.phrases:
            weight = reduce(lambda a, c: a + c, [F.col(f"c{c}") * WEIGHTS[c] for c in (_COLUMNS if p.columns is None else p.columns)], F.lit(0.0))
            f[p] = F.sum(F.when(F.col("term") == p.terms[0], weight).otherwise(0.0))
        each = rows.groupBy("chunk_id").agg(F.max("words").alias("words"), *[f[p].alias(f"f{k}") for k, p in enumerate(self.phrases)])
        present = {p: F.col(f"f{k}") > 0 for k, p in enumerate(self.phrases)}
        total = F.lit(0.0)
        for p, within in scored_phrases(self.node):
            part = gain(F.col(f"f{self.phrases.index(p)}"), F.col("words"), self.index.mean, self.idf[p])
            counts = reduce(lambda a, c: a & c, [_holds(w, present, False) for w in within], present[p])
            total = total + F.when(counts, part).otherwise(0.0)
        return each.where(_holds(self.node, present, False)).select("chunk_id", (-total).alias("score"))


def best_hits(index: Blocks, node, k: int, meta: DataFrame, order: list[Column], first: int = FIRST) -> DataFrame:
    """The `k` best rows of meta (chunk_id and what `order` needs), with their scores, in the order of score and `order`."""
    query = Query(index, node)
    bounds = cut_lineage(query.bounds())

    def top(spans: DataFrame) -> DataFrame:
        return query.scores(spans).join(meta, "chunk_id").orderBy("score", *order).limit(k)

    begun = cut_lineage(bounds.orderBy(F.desc("bound"), "span").limit(first))
    early = cut_lineage(top(begun))
    n, worst = early.agg(F.count("*"), F.max("score")).first()
    rest = bounds.join(begun.select("span"), "span", "left_anti")
    if n == k:  # a hit that scores as the k-th may come before it
        rest = rest.where(F.col("bound") >= -worst)
    return early.unionByName(top(rest)).orderBy("score", *order).limit(k)


def read_share(index: Blocks, node, k: int, lengths: DataFrame, first: int = FIRST) -> dict[str, tuple[int, int]]:
    """Of each word, how many postings best_hits() reads and how many there are."""
    query = Query(index, node)
    bounds = cut_lineage(query.bounds())
    begun = cut_lineage(bounds.orderBy(F.desc("bound"), "span").limit(first))
    early = query.scores(begun).join(lengths, "chunk_id").orderBy("score", "chunk_id").limit(k)
    n, worst = early.agg(F.count("*"), F.max("score")).first()
    rest = bounds.join(begun.select("span"), "span", "left_anti")
    read = begun.unionByName(rest.where(F.col("bound") >= -worst) if n == k else rest)
    size = F.size("postings").cast("long")
    every = query.blocks().groupBy("term").agg(F.sum(size).alias("all"))
    mine = query.blocks().join(read.select("span"), "span", "left_semi").groupBy("term").agg(F.sum(size).alias("read"))
    return {r["term"]: (r["read"] or 0, r["all"]) for r in every.join(mine, "term", "left").collect()}
