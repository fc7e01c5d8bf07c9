"""Expansion of a citation graph, resumable: what was expanded or judged before is known from logs and left out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.sources.writers import insert_new

from .graph import cut_lineage


def expand_limited(
    edges: DataFrame, seeds: DataFrame, known: DataFrame, processed: DataFrame, *, depth: int, per_paper: int, most: int, direction: str = "backward"
) -> tuple[DataFrame, DataFrame]:
    """(new edges, newly processed keys): from seeds (paper_id, ord) along edges (src, dst, ord), breadth first.

    A paper gives its first `per_paper` neighbours; one whose key `direction:paper:step` was processed gives none. Edges that
    are known don't count, and after `most` new ones all ends: in the order of the queue, a paper's place is that of the
    first edge that reached it. Both directions are two expansions of one queue.
    """
    sides = {"backward": [("src", "dst")], "forward": [("dst", "src")], "both": [("src", "dst"), ("dst", "src")]}[direction]
    hops = [edges.select(F.col(a).alias("paper_id"), F.col(b).alias("other"), "src", "dst", F.lit(k).alias("side"), "ord") for k, (a, b) in enumerate(sides)]
    hops = reduce(DataFrame.unionByName, hops).where("src is not null and dst is not null")
    hops = hops.groupBy("paper_id", "side", "other", "src", "dst").agg(F.min("ord").alias("ord"))
    frontier = cut_lineage(seeds.groupBy("paper_id").agg(F.array(F.min("ord")).alias("place")))
    seen, taken, marks = frontier.select("paper_id"), None, None
    old = known.select("src", "dst").distinct()
    for step in range(depth):
        key = F.concat(F.lit(f"{direction}:"), F.col("paper_id").cast("string"), F.lit(f":{step}"))
        open_ = frontier.withColumn("key", key).join(processed.select("key"), "key", "left_anti")
        near = hops.join(open_, "paper_id")
        rank = F.array_position(F.col("all"), F.struct("side", "ord", "other")).cast("long")
        # a paper's neighbours in order, `per_paper` of each side at most
        first = near.groupBy("paper_id", "side").agg(F.slice(F.array_sort(F.collect_list(F.struct("side", "ord", "other"))), 1, per_paper).alias("part"))
        all_ = first.groupBy("paper_id").agg(F.flatten(F.array_sort(F.collect_list("part"))).alias("all"))
        ranked = near.join(all_, "paper_id").withColumn("r", rank).where("r > 0").withColumn("place", F.concat("place", F.array("r")))
        fresh = ranked.join(old, ["src", "dst"], "left_anti").groupBy("src", "dst").agg(F.min("place").alias("place"))
        room = most - (taken.count() if taken is not None else 0)
        added = cut_lineage(fresh.orderBy("place").limit(room))
        reached = added.agg(F.count("*").alias("n"), F.max("place").alias("last")).first()
        full = reached["n"] >= room
        worked = open_.select("key", "place")
        if full:  # papers after the last new edge weren't looked at
            worked = worked.where(F.col("place") <= F.slice(F.lit(reached["last"]).cast("array<long>"), 1, step + 1)) if reached["last"] else worked.limit(0)
            ranked = ranked.where(F.col("place") <= F.lit(reached["last"]).cast("array<long>")) if reached["last"] else ranked.limit(0)
        marks = worked.select("key") if marks is None else marks.unionByName(worked.select("key"))
        taken = added.select("src", "dst") if taken is None else taken.unionByName(added.select("src", "dst"))
        old = old.unionByName(added.select("src", "dst"))
        frontier = cut_lineage(ranked.groupBy(F.col("other").alias("paper_id")).agg(F.min("place").alias("place")).join(seen, "paper_id", "left_anti"))
        seen = cut_lineage(seen.unionByName(frontier.select("paper_id")))
        if full or frontier.isEmpty():
            break
    return taken, marks


def evaluated_ids(*logs: DataFrame) -> DataFrame:
    """Papers that any log has judged."""
    return reduce(DataFrame.unionByName, [log.select("paper_id") for log in logs]).where("paper_id is not null").distinct()


def id_map(papers: DataFrame, mapped: DataFrame) -> DataFrame:
    """(key, canonical): identifiers of papers (paper_id, doi, corpus_id, arxiv, pubmed, ord) and of the kept map
    (canonical_id, doi, s2_id, arxiv_id, pubmed_id, mag_id, dblp_id, ord). The map wins over papers, and later rows over earlier."""
    kinds = lambda pairs: F.array(*[F.concat(F.lit(prefix), text.falsy_to_null(c.cast("string"))) for prefix, c in pairs])
    doi = lambda c: text.normalize_doi(F.col(c))
    own = kinds([("", F.col("paper_id")), ("doi:", doi("doi")), ("s2:", F.col("corpus_id")), ("arxiv:", F.col("arxiv")), ("pubmed:", F.col("pubmed"))])
    kept = kinds([("", F.col("canonical_id")), ("doi:", doi("doi")), ("s2:", F.col("s2_id")), ("arxiv:", F.col("arxiv_id")), ("pubmed:", F.col("pubmed_id")), ("mag:", F.col("mag_id")), ("dblp:", F.col("dblp_id"))])
    rows = papers.select(F.explode(own).alias("key"), F.col("paper_id").alias("canonical"), F.struct(F.lit(0).alias("side"), "ord").alias("rank"))
    rows = rows.unionByName(mapped.select(F.explode(kept).alias("key"), F.col("canonical_id").alias("canonical"), F.struct(F.lit(1).alias("side"), "ord").alias("rank")))
    return rows.where("key is not null and canonical is not null").groupBy("key").agg(F.max_by("canonical", "rank").alias("canonical"))


def resolved(neighbours: DataFrame, ids: DataFrame) -> DataFrame:
    """neighbours (doi, corpus_id, arxiv, and what names an unknown paper) with `canonical`: by DOI, corpus id, arXiv number, else a new id."""
    rows = neighbours.withColumn("__row", F.monotonically_increasing_id())
    keys = F.array(F.concat(F.lit("doi:"), text.falsy_to_null(text.normalize_doi(F.col("doi")))), F.concat(F.lit("s2:"), text.falsy_to_null(F.col("corpus_id"))), F.concat(F.lit("arxiv:"), text.falsy_to_null(F.col("arxiv"))))
    rows = cut_lineage(rows.withColumn("__keys", keys))
    hits = rows.select("__row", F.posexplode("__keys").alias("at", "key")).join(ids, "key").groupBy("__row").agg(F.min_by("canonical", "at").alias("__known"))
    new = text.canonical_id(F.col("doi"), F.col("corpus_id"), F.lit(None).cast("string"), F.col("title"), F.col("year"), F.get("authors", F.lit(0)))
    return rows.join(hits, "__row", "left").withColumn("canonical", F.coalesce("__known", new)).drop("__row", "__keys", "__known")


def recursive_expansion(core: DataFrame, expanded: DataFrame, evaluated: DataFrame, known: DataFrame, ids: DataFrame, neighbours: DataFrame) -> dict[str, DataFrame]:
    """One run: core papers not expanded yet get their neighbours' edges, and new neighbours are to be judged.

    neighbours (paper_id, relation `references` or `citations`, title, year, authors, abstract, doi, corpus_id, arxiv, ord)
    are what a service says of papers; rows without a title are left out. Returns edges (src, dst; not deduplicated),
    discovered papers (canonical, parent, depth 1 and data), pending ones (paper_id, title, abstract), state (paper_id, n_refs,
    n_cites) of every paper expanded now, and stats (one row).
    """
    queue = core.select("paper_id").distinct().join(expanded.select("paper_id"), "paper_id", "left_anti")
    rows = cut_lineage(neighbours.join(queue, "paper_id", "left_semi"))
    titled = cut_lineage(resolved(rows.where(text.has_text(F.col("title"))), ids))
    refs = F.col("relation") == "references"
    edges = titled.select(F.when(refs, F.col("paper_id")).otherwise(F.col("canonical")).alias("src"), F.when(refs, F.col("canonical")).otherwise(F.col("paper_id")).alias("dst"))
    place = F.struct("paper_id", (~refs).alias("side"), "ord")
    fresh = titled.join(evaluated.select(F.col("paper_id").alias("canonical")), "canonical", "left_anti")
    first = fresh.groupBy("canonical").agg(F.min_by(F.struct(F.col("paper_id").alias("parent"), "title", "year", "authors", "abstract", "doi", "corpus_id", "arxiv"), place).alias("x")).select("canonical", "x.*")
    first = cut_lineage(first)
    discovered = insert_new(first, known.select(F.col("paper_id").alias("canonical")), ["canonical"]).withColumn("depth", F.lit(1))
    counts = rows.groupBy("paper_id").agg(F.count_if(refs).alias("n_refs"), F.count_if(~refs).alias("n_cites"))
    state = queue.join(counts, "paper_id", "left").na.fill(0, ["n_refs", "n_cites"])
    pending = first.select(F.col("canonical").alias("paper_id"), "title", "abstract")
    ones = [("seeds", core.select("paper_id").distinct()), ("expanded", queue), ("edges_stored", edges), ("discovered", discovered), ("pending_classification", pending)]
    stats = reduce(DataFrame.crossJoin, [df.agg(F.count("*").alias(name)) for name, df in ones])  # one row each
    return {"edges": edges, "discovered": discovered, "pending": pending, "state": state, "stats": stats}


def discovered_records(discovered: DataFrame, source: str, fetched_at: Column) -> DataFrame:
    """Rows of the log of discovered papers: ids, data and provenance with depth and parent."""
    ids = F.map_filter(F.create_map(F.lit("DOI"), "doi", F.lit("CorpusId"), "corpus_id", F.lit("ArXiv"), "arxiv"), lambda _, v: v.isNotNull())
    authors = F.transform("authors", lambda a: F.struct(a.alias("name")))
    provenance = F.struct(F.lit(source).alias("source"), fetched_at.alias("fetched_at"), "depth", "parent")
    return discovered.select(F.col("canonical").alias("paper_id"), ids.alias("external_ids"), "title", "year", authors.alias("authors"), "abstract", provenance.alias("provenance"))
