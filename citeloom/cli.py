"""Command line: `python -m citeloom.cli GROUP COMMAND ...`. Commands print JSON."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text


def _session() -> SparkSession:
    return SparkSession.builder.appName("citeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _show(found) -> None:
    print(json.dumps(found, ensure_ascii=False, default=str, indent=2))


def _rows(df) -> list[dict]:
    return [r.asDict(True) for r in df.collect()]


def corpus_build(spark, a):
    """Markdown below a folder, with metadata and labels of a warehouse, to documents, chunks and postings."""
    from citeloom.client import Warehouse
    from citeloom.operators import corpus, search, topk
    from citeloom.sources import records

    house = Warehouse(spark, a.data)
    files = records.read_markdown(spark, a.folder).withColumn("origin", F.lit("drive")).withColumn("ord", F.xxhash64("source_path"))
    docs, chunks = corpus.build_documents(files, house.papers, house.labels)
    docs.write.mode("overwrite").parquet(f"{a.index}/documents")
    docs = spark.read.parquet(f"{a.index}/documents")
    chunks.withColumn("chunk_id", F.xxhash64("document_id", "chunk_no")).write.mode("overwrite").parquet(f"{a.index}/chunks")
    chunks = spark.read.parquet(f"{a.index}/chunks")
    search.postings(search.searchable(docs, chunks)).repartition("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{a.index}/postings")
    index = spark.read.parquet(f"{a.index}/postings")
    topk.built(index, search.chunk_lengths(index, chunks), f"{a.index}/top")
    _show(_rows(corpus.corpus_stats(docs, chunks)))


def _index(spark, a):
    return [spark.read.parquet(f"{a.index}/{t}") for t in ("documents", "chunks", "postings")]


def corpus_search(spark, a):
    from citeloom.operators import search, topk
    from citeloom.sources import records

    blocks = topk.opened(spark, f"{a.index}/top") if records.path_exists(spark, f"{a.index}/top/sizes") else None
    _show(_rows(search.search(*_index(spark, a), a.query, blocks=blocks, limit=a.limit, category=a.category, year_min=a.year_min, year_max=a.year_max, all_versions=a.all_versions, low_quality=a.low_quality, back_matter=a.back_matter)))


def corpus_stats(spark, a):
    from citeloom.operators import corpus

    docs, chunks, _ = _index(spark, a)
    _show({"counts": _rows(corpus.corpus_stats(docs, chunks)), "facets": _rows(corpus.grouped_stats(docs))})


def corpus_latest(spark, a):
    from citeloom.operators import corpus

    docs = spark.read.parquet(f"{a.index}/documents").drop("text")
    _show(_rows(corpus.latest_documents(docs, limit=a.limit, category=a.category)))


def corpus_read(spark, a):
    from citeloom.operators import corpus

    found = corpus.find_document(spark.read.parquet(f"{a.index}/documents"), a.selector)
    lines = corpus.read_lines(found, a.start, a.end).orderBy("line_no").collect()
    if not lines:
        raise KeyError(a.selector)
    print("\n".join(f"{r.line_no:>6}  {r.line}" for r in lines))


def house_call(spark, a):
    """A method of the warehouse client, by name."""
    from citeloom.client import Warehouse

    _show(getattr(Warehouse(spark, a.data, a.corpus), a.command)(*a.args))


def audit(spark, a):
    from citeloom.client import Warehouse
    from citeloom.functions import fixed
    from citeloom.operators import citations, labels
    from citeloom.sources import records

    house = Warehouse(spark, a.data)
    log = records.read_log(spark, f"{a.data}/classifications_7cat.jsonl", records.LABELS, strict=False)
    kept = log.where(F.col("category").isin(*fixed.CORE_CATEGORIES, *fixed.SECONDARY_CATEGORIES)).join(house.papers, "paper_id", "left")
    strange = kept.where(text.eeg_only_in_audit(F.col("title"), F.col("abstract")))
    edges = records.read_log(spark, f"{a.data}/citations.jsonl", records.CITATIONS, strict=False).select(F.col("from").alias("src"), F.col("to").alias("dst"))
    counts = edges.agg(F.count("*").alias("edges"), F.countDistinct("src", "dst").alias("distinct_edges"))
    _show({"distribution": _rows(labels.distribution(log)), "eeg_only": strange.count(), "eeg_only_first": _rows(strange.select("paper_id", F.substring("title", 1, 80).alias("title")).limit(5)), "edges": _rows(counts), "degrees": citations.degrees(house.edges).count()})


def qc(spark, a):
    from citeloom.operators import papers
    from citeloom.sources import records

    rows = records.read_log(spark, f"{a.data}/papers.jsonl", records.PAPERS)
    flat = rows.select("paper_id", "title", F.expr("try_cast(year as int)").alias("year"), "venue", F.col("provenance.source").alias("source"), F.col("provenance.fetched_at").alias("fetched_at"), "ord")
    edges = records.read_log(spark, f"{a.data}/citations.jsonl", records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"))
    _show(_rows(papers.quality_report(flat, edges)))


def classify(spark, a):
    from citeloom.operators import labels
    from citeloom.sources import records, writers

    log_path = f"{a.data}/classifications_7cat.jsonl"
    log = records.read_log(spark, log_path, records.LABELS, strict=False)
    if a.command == "prepare":
        papers = records.read_papers(spark, f"{a.data}/discovered_papers.jsonl", strict=False)
        open_ = papers.join(log.select("paper_id"), "paper_id", "left_anti").groupBy("paper_id").agg(F.min_by(F.struct("title", F.substring("abstract", 1, 600).alias("abstract")), "ord").alias("x"))
        numbered = labels.numbered_batches(open_.select("paper_id", "x.*"), [F.col("paper_id")], a.size)
        numbered.drop("place").write.mode("overwrite").partitionBy("batch").json(f"{a.data}/classify_batches")
        _show({"papers": numbered.count()})
    elif a.command == "ingest":
        lines = spark.read.text(a.path, wholetext=True)
        rows = labels.normalized_answers(records.answers_in_text(lines))
        new = writers.insert_new(rows, log, ["paper_id"], F.xxhash64("paper_id", "category"))
        writers.append_log(new.withColumn("classified_at", text.now_iso()), log_path)
        _show({"read": rows.count()})
    elif a.command == "extract-logs":
        _show(_rows(records.answers_in_logs(spark.read.text(a.path)).distinct()))
    else:
        batches = records.read_batches(spark, f"{a.data}/classify_batches/*/*.json")
        _show(_rows(labels.category_status(labels.last_labels(log), batches)))


def build_network(spark, a):
    from citeloom.client import Warehouse
    from citeloom.functions import fixed
    from citeloom.operators import citations, labels
    from citeloom.operators.graph import cut_lineage
    from citeloom.sources import records, writers

    read = lambda name, schema: records.read_log(spark, f"{a.data}/{name}", schema, strict=False)
    answers = read("haiku_classifications.jsonl", "paper_id string, is_fmri_gnn boolean").withColumnRenamed("is_fmri_gnn", "is_positive")
    tags = cut_lineage(labels.layered_labels(read("classifications.jsonl", "paper_id string, category string"), answers, read("classifications_7cat.jsonl", records.LABELS)))
    core, secondary = (tags.where(F.col("category").isin(*c)).select("paper_id") for c in (fixed.CORE_CATEGORIES, fixed.SECONDARY_CATEGORIES))
    rows = read("citations.jsonl", records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"), F.coalesce("relation", F.lit("cites")).alias("relation"), "source", "ord")
    edges = cut_lineage(citations.network_edges(rows.where("src <> '' and dst <> ''"), core.union(secondary)))
    nodes = cut_lineage(citations.network_nodes(core, secondary, citations.boundary_nodes(edges)))
    house = Warehouse(spark, a.data)
    full = nodes.join(tags, "paper_id", "left").na.fill(fixed.EXCLUDED_CATEGORY, ["category"]).join(house.papers, "paper_id", "left")
    writers.overwrite_log(full, f"{a.data}/network/nodes", "paper_id")
    writers.overwrite_log(edges.select(F.col("src").alias("from"), F.col("dst").alias("to"), "relation", "source"), f"{a.data}/network/edges")
    by_category = citations.category_distribution(nodes, tags, fixed.EXCLUDED_CATEGORY).groupBy("category").agg(F.sum("n").alias("n")).orderBy("category")
    built_at = spark.range(1).select(text.now_iso().alias("at")).first()["at"]
    stats = citations.stats_file(citations.network_stats(nodes, edges).first().asDict(), {r["category"]: r["n"] for r in by_category.collect()}, str(built_at))
    writers.write_json(f"{a.data}/network/network_stats.json", stats)
    _show(stats)


def _read(spark, a):
    from citeloom.sources import records

    return lambda name, schema: records.read_log(spark, f"{a.data}/{name}", schema, strict=False)


def _flat_papers(spark, a):
    """papers.jsonl with plain identifiers, in the order of the log."""
    rows = _read(spark, a)("papers.jsonl", _schema("PAPERS"))
    corpus = F.coalesce("corpusId", F.col("externalIds")["CorpusId"])
    doi = text.falsy_to_null(text.normalize_doi(F.coalesce("doi", F.col("externalIds")["DOI"])))
    return rows.select("paper_id", "title", F.expr("try_cast(year as int)").alias("year"), "venue", doi.alias("doi"), corpus.alias("corpus_id"), "openalex_id", "abstract", "ord")


def _schema(name: str) -> str:
    from citeloom.sources import records

    return getattr(records, name)


def http_transport(bases: dict[str, str], timeout: float = 30.0):
    """What makes a transport in a task: GET requests of the standard library, answers as JSON; a 404 is no answer."""

    def make():
        import urllib.error
        import urllib.parse
        import urllib.request

        def get(path: str, params: dict):
            service = params.pop("__service", "semantic_scholar")
            url = bases[service] + urllib.parse.quote(path, safe="/:") + ("?" + urllib.parse.urlencode(params) if params else "")
            try:
                with urllib.request.urlopen(url, timeout=timeout) as answer:
                    return json.load(answer)
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None
                raise
        return get

    return make


# Addresses of services.
SERVICES = {"semantic_scholar": "https://api.semanticscholar.org/graph/v1", "openalex": "https://api.openalex.org", "crossref": "https://api.crossref.org", "europe_pmc": "https://www.ebi.ac.uk/europepmc/webservices/rest", "doi": "https://doi.org"}


def _transport(service: str):
    return http_transport({"semantic_scholar": SERVICES[service]})


def init(spark, a):
    from citeloom.sources import settings

    _show({"made": settings.scaffold(a.data)})


def ingest_seeds(spark, a, transport=_transport):
    """The first paper that a search finds for each seed, if the log doesn't have it."""
    from citeloom.sources import records, services, settings, writers

    seeds = settings.read_seeds(spark, f"{a.data}/seeds.yaml")
    confidence = settings.read_settings(f"{a.data}/settings.yaml")["confidence"]
    left, found = seeds.select(F.col("query").alias("id")), None
    for service, shape in (("semantic_scholar", services.standardize_s2), ("openalex", services.standardize_openalex)):
        rows = shape(services.called(left, "id", service, "search", transport(service), limit=1)).withColumn("source", F.lit(service)).cache()
        found = rows if found is None else found.unionByName(rows)
        left = left.join(rows.select("id"), "id", "left_anti")
    paper = text.canonical_id(F.col("doi"), F.col("corpus_id"), F.col("openalex_id"), F.col("title"), F.col("year"), F.get("authors", F.lit(0)))
    rows = found.withColumn("paper_id", paper).join(seeds.withColumnRenamed("query", "id"), "id")
    stamp = F.struct("source", text.now_iso().alias("fetched_at"), F.lit(float(confidence)).alias("confidence"))
    known = records.read_log(spark, f"{a.data}/papers.jsonl", records.PAPERS, strict=False)
    new = writers.insert_new(rows, known, ["paper_id"], F.col("ord"))
    kept = new.select("paper_id", "title", F.col("year").cast("string").alias("year"), "venue", "doi", F.col("corpus_id").alias("corpusId"), "openalex_id", F.col("tag").alias("seed_tag"), "source", stamp.alias("provenance"))
    n = writers.append_lines(kept, f"{a.data}/papers.jsonl")
    _show({"seeds": seeds.count(), "added": n})


def consolidate_seeds(spark, a):
    from citeloom.operators import backfill
    from citeloom.sources import records, writers

    read = _read(spark, a)
    binary = read("haiku_classifications.jsonl", "paper_id string, is_fmri_gnn boolean").where("is_fmri_gnn")
    named = read("classifications.jsonl", "paper_id string, category string").where("category = 'fmri_gnn'")
    columns = ["paper_id", "title", "year", "venue", "abstract", "doi", "ord"]
    old, new = (read(n, records.PAPERS).select(*columns) for n in ("papers.jsonl", "discovered_papers.jsonl"))
    seeds = backfill.consolidated_seeds([binary, named], old, new, read("abstracts.jsonl", "paper_id string, abstract string"))
    _show({"confirmed_seeds": writers.write_lines(seeds.withColumn("source", F.lit("consolidate_seeds")), f"{a.data}/confirmed_seeds.jsonl", "paper_id")})


def backfill_metadata(spark, a):
    """Title, year and venue from cached responses; with --dry-run only what could be done."""
    from citeloom.operators import backfill
    from citeloom.sources import records, writers

    papers = _flat_papers(spark, a)
    if a.dry_run:
        _show(_rows(backfill.missing_counts(papers)))
        return
    last = papers.groupBy("paper_id").agg(F.max_by(F.struct(*[c for c in papers.columns if c != "paper_id"]), "ord").alias("x")).select("paper_id", "x.*")
    filled = backfill.filled(last, backfill.mined_metadata(last, _responses(spark, a)), text.now_iso(), 0.7)
    _show({"filled": writers.append_lines(filled.drop("ord", "abstract").withColumn("year", F.col("year").cast("string")).withColumnRenamed("corpus_id", "corpusId"), f"{a.data}/papers.jsonl")})


def _responses(spark, a):
    from citeloom.sources import records

    path = f"{a.data}/cache/*.json"
    if not records.path_exists(spark, path):
        return spark.createDataFrame([], "ord long, value string")
    return spark.read.text(path, wholetext=True).select(F.xxhash64("_metadata.file_path").alias("ord"), "value")


def abstracts(spark, a, transport=_transport):
    """Abstracts of papers without one: cached responses first, then, with --fetch, DOIs and title searches."""
    from citeloom.functions import documents
    from citeloom.operators import backfill
    from citeloom.operators.graph import cut_lineage
    from citeloom.sources import records, services, writers

    known = _read(spark, a)("abstracts.jsonl", "paper_id string, abstract string")
    papers = _flat_papers(spark, a).groupBy("paper_id").agg(F.max_by(F.struct("title", "doi", "corpus_id", "openalex_id", "ord"), "ord").alias("x")).select("paper_id", "x.*")
    open_ = cut_lineage(papers.join(known.select("paper_id"), "paper_id", "left_anti"))
    found = backfill.mined_abstracts(open_, _responses(spark, a))

    def by_doi(rows):
        got = services.called(rows.where("doi <> ''"), "doi", "doi", "paper", transport("doi"))
        return rows.join(services.csl_abstracts(got).withColumnRenamed("id", "doi"), "doi").select("paper_id", "abstract")

    def by_title(rows):
        asked = rows.where(F.length("title") > 10)
        got = services.europe_pmc_abstracts(services.called(asked, "title", "europe_pmc", "title", transport("europe_pmc"), limit=5))
        hits = got.join(asked.select("paper_id", F.col("title").alias("id")), "id").select("paper_id", documents.normalize_loosely("title").alias("key"), "abstract", "ord")
        return backfill.title_candidates(asked.select("paper_id", documents.normalize_loosely("title").alias("key")), hits)

    if a.fetch:
        left = open_.join(found.select("paper_id"), "paper_id", "left_anti")
        # what was tried before, found or not, isn't asked for again
        worked = f"{a.data}/worked_abstracts"
        tried, asked = cut_lineage(writers.known_keys(spark, worked)), []

        def noted(name, phase):
            def run(rows):
                asked.append(rows.select(F.concat(F.lit(f"{name}:"), "paper_id").alias("key")))
                return phase(rows)

            return name, run

        found = cut_lineage(found.unionByName(backfill.in_phases(left, tried, [noted("doi_csl", by_doi), noted("europe_pmc_title", by_title)])))
        for keys in asked:
            writers.mark_keys(keys, worked)
    _show({"found": writers.append_lines(found, f"{a.data}/abstracts.jsonl")})


def export(spark, a):
    """The network's files if a network was built, else papers and citations, as tables and GraphML."""
    from citeloom.sources import records, writers

    read = _read(spark, a)
    built = records.path_exists(spark, f"{a.data}/network/nodes.jsonl") or records.path_exists(spark, f"{a.data}/network/nodes/*.json")
    if built:
        nodes = spark.read.json([f"{a.data}/network/nodes.jsonl" if records.path_exists(spark, f"{a.data}/network/nodes.jsonl") else f"{a.data}/network/nodes"])
        edges = spark.read.json([f"{a.data}/network/edges.jsonl" if records.path_exists(spark, f"{a.data}/network/edges.jsonl") else f"{a.data}/network/edges"])
    else:
        nodes, edges = _flat_papers(spark, a).drop("ord", "abstract"), read("citations.jsonl", records.CITATIONS)
    plain = [c for c, t in nodes.dtypes if not t.startswith(("array", "struct", "map"))]
    nodes = nodes.select(*plain).dropDuplicates(["paper_id"])
    edges = edges.select(F.col("from").alias("src"), F.col("to").alias("dst")).where("src is not null and dst is not null").distinct()
    writers.write_csv(nodes, f"{a.data}/graph/nodes.csv")
    writers.write_csv(edges, f"{a.data}/graph/edges.csv")
    _show({"nodes": nodes.count(), "edges": writers.write_graphml(nodes, edges, f"{a.data}/graph/network.graphml"), "network": built})


def cluster(spark, a):
    from citeloom.operators import communities
    from citeloom.sources import records, settings

    edges = _read(spark, a)("citations.jsonl", records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"))
    found = communities.communities(edges).cache()
    summary = communities.community_summary(found, _flat_papers(spark, a).select("paper_id", "title", "venue"))
    _show({"clusters": settings.write_clusters(settings.clusters_of(summary, found), f"{a.data}/graph/clusters.yaml", f"{a.data}/notes/cluster-summaries.md")})


def expand(spark, a):
    """Edges of cached citation pages around the papers of the log, within the limits; worked keys are kept."""
    from citeloom.operators import expansion
    from citeloom.sources import records, writers

    seeds = _flat_papers(spark, a).select("paper_id", "ord")
    edges = _read(spark, a)(a.edges, records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"), "ord")
    known = _read(spark, a)("citations.jsonl", records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"))
    processed = _read(spark, a)("processed.jsonl", "key string")
    added, keys = expansion.expand_limited(edges, seeds, known, processed, depth=a.depth, per_paper=a.limit, most=a.most, direction=a.direction)
    n = writers.append_lines(added.select(F.col("src").alias("from"), F.col("dst").alias("to"), F.lit(a.direction).alias("relation")), f"{a.data}/citations.jsonl")
    writers.append_lines(keys, f"{a.data}/processed.jsonl")
    _show({"edges_added": n})


def enrich(spark, a, transport=_transport):
    """Metadata of papers that lack it, by DOI."""
    from citeloom.operators import backfill
    from citeloom.sources import services, writers

    papers = _flat_papers(spark, a)
    last = papers.groupBy("paper_id").agg(F.max_by(F.struct(*[c for c in papers.columns if c != "paper_id"]), "ord").alias("x")).select("paper_id", "x.*")
    open_ = last.where(text.missing_metadata(F.col("title"), F.col("year"), F.col("venue")) & text.has_text(F.col("doi")))
    got = services.standardize_crossref(services.called(open_, "doi", "crossref", "paper", transport("crossref")))
    found = open_.select("paper_id", "doi").join(got.withColumnRenamed("id", "doi"), "doi").select("paper_id", "title", "year", "venue", F.lit("crossref").alias("source"))
    filled = backfill.filled(last, found, text.now_iso(), 0.7)
    _show({"enriched": writers.append_lines(filled.drop("ord", "abstract").withColumn("year", F.col("year").cast("string")).withColumnRenamed("corpus_id", "corpusId"), f"{a.data}/papers.jsonl")})


def recursive_expand(spark, a, transport=_transport):
    """Neighbours of core papers not expanded yet; new ones are written to be judged."""
    from citeloom.functions import fixed
    from citeloom.operators import expansion, labels
    from citeloom.operators.graph import cut_lineage
    from citeloom.sources import records, services, writers

    read = _read(spark, a)
    log = read("classifications_7cat.jsonl", records.LABELS)
    judged = expansion.evaluated_ids(log, *(read(n, "paper_id string") for n in ("classifications.jsonl", "haiku_classifications.jsonl")))
    papers = _flat_papers(spark, a)
    found = read("discovered_papers.jsonl", records.PAPERS)
    known = papers.select("paper_id").unionByName(found.select("paper_id")).distinct()
    kept = read("id_map.jsonl", "canonical_id string, doi string, s2_id string, arxiv_id string, pubmed_id string, mag_id string, dblp_id string")
    none = F.lit(None).cast("string")
    ids = cut_lineage(expansion.id_map(papers.withColumn("arxiv", none).withColumn("pubmed", none), kept))
    core = log.where(F.col("category").isin(*fixed.CORE_CATEGORIES)).select("paper_id").distinct()
    state = read("expansion_state.jsonl", "paper_id string")
    by_id = known.join(papers.groupBy("paper_id").agg(F.max_by(F.struct("doi", "corpus_id"), "ord").alias("x")).select("paper_id", "x.*"), "paper_id", "left")
    asked = core.join(state, "paper_id", "left_anti").join(by_id, "paper_id", "left").select("paper_id", text.expansion_lookup(F.col("paper_id"), F.col("doi"), F.col("corpus_id")).alias("id"))
    rows = None
    for call in ("references", "citations"):
        got = services.called(asked, "id", "semantic_scholar", call, transport("semantic_scholar"), limit=500)
        data = services.standardize_s2_rows(got).withColumn("relation", F.lit(call)).join(asked, "id").drop("id")
        rows = data if rows is None else rows.unionByName(data)
    run = expansion.recursive_expansion(core, state, judged, known, ids, cut_lineage(rows))
    run = {k: cut_lineage(v) for k, v in run.items()}
    stamp = text.now_iso()
    # the state goes last, so a run that was broken off is done again
    writers.append_lines(run["edges"].select(F.col("src").alias("from"), F.col("dst").alias("to"), F.lit("cites").alias("relation"), F.lit("s2_recursive_expand").alias("source"), stamp.alias("fetched_at")), f"{a.data}/citations.jsonl")
    writers.append_lines(expansion.discovered_records(run["discovered"], "s2_recursive_expand", stamp), f"{a.data}/discovered_papers.jsonl")
    writers.append_lines(run["discovered"].select(F.col("canonical").alias("canonical_id"), "doi", F.col("corpus_id").alias("s2_id"), F.col("arxiv").alias("arxiv_id")), f"{a.data}/id_map.jsonl")
    numbered = labels.numbered_batches(run["pending"], [F.col("paper_id")], a.size)
    writers.write_batches(numbered, f"{a.data}/expand_classify_batches")
    writers.append_lines(run["state"].withColumn("expanded_at", stamp).withColumn("depth", F.lit(0)), f"{a.data}/expansion_state.jsonl")
    _show(_rows(run["stats"]))


def literature_neighborhood(spark, a, transport=_transport):
    from citeloom.operators import neighbourhood as N
    from citeloom.operators.graph import cut_lineage
    from citeloom.sources import services, writers

    make = transport("semantic_scholar")
    as_rows = lambda got: got.select("id", "ord", F.from_json("record", N.RECORD).alias("r")).select("id", "ord", "r.*")
    met = None
    for call, given, kind in (("search", a.query, "query"), ("paper", a.paper, "paper_id")):
        if given:
            got = services.called(spark.createDataFrame([(q,) for q in given], "id string"), "id", "semantic_scholar", call, make, limit=a.seeds)
            rows = as_rows(got).withColumn("seen_in", F.concat(F.lit(f"{kind}:"), "id")).drop("id")
            met = rows if met is None else met.unionByName(rows)
    if met is None:
        raise ValueError("a query or a paper is needed")
    seeds = cut_lineage(N.compact(met))
    asked = seeds.select("paper_id", F.coalesce("s2_paper_id", "corpus_id").alias("id")).where("id is not null").distinct()
    near = []
    for call in ("references", "citations"):
        got = services.called(asked, "id", "semantic_scholar", call, make, limit=a.limit)
        rows = as_rows(got).join(asked.withColumnRenamed("paper_id", "seed"), "id").withColumn("ord", F.xxhash64("seed").bitwiseAND(F.lit((1 << 40) - 1)) * 10_000 + F.col("ord") + (1 if call == "citations" else 0)).drop("id")
        near.append(N.compact(rows))
    nodes, edges = (cut_lineage(df) for df in N.neighbourhood(seeds, *near))
    page = N.summary(nodes, edges, a.query or [], a.paper or [])
    name = a.name or "neighbourhood"
    _show(writers.write_neighbourhood(nodes, edges, page, f"{a.data}/literature_neighborhoods", name))


def _get_page(address: str) -> tuple[int, str]:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(address, timeout=45) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""


def fetch_arxiv(spark, a, get=_get_page):
    """A paper's page as Markdown in the corpus folder, with its row of the index."""
    from pathlib import Path

    from citeloom.functions.documents import readable
    from citeloom.sources import services, writers

    number = a.number.strip().removeprefix("arXiv:").removeprefix("arxiv:")
    address, page = services.arxiv_page(get, number, a.address)
    paper_id, title = f"doi:10.48550/arxiv.{number.lower()}", a.title or f"arXiv:{number}"
    body = f"# {title}\n\nSource: {address}\n\nPaper ID: {paper_id}\n\n{readable(page)}\n"
    where = Path(a.folder) / "fulltext" / f"doi_10.48550_arxiv.{number}.manual.md"
    where.parent.mkdir(parents=True, exist_ok=True)
    where.write_text(body, encoding="utf-8")
    record = {"paper_id": paper_id, "title": title, "year": a.year, "venue": "arXiv", "fulltext_file": f"fulltext/{where.name}", "source_tag": "manual", "format": "markdown", "has_metadata": bool(a.title or a.year), "n_chars": len(body), "url": f"https://arxiv.org/abs/{number}"}
    writers.replace_line(f"{a.folder}/INDEX.jsonl", record)
    _show(record)


def catalog(spark, a):
    """The pages of the catalog."""
    from citeloom.operators import pages
    from citeloom.operators.graph import cut_lineage
    from citeloom.sources import writers

    papers = cut_lineage(_catalogued(spark, a))
    _show({"pages": writers.write_pages(pages.page_lines(papers).unionByName(pages.index_lines(papers)), a.folder)})


def _catalogued(spark, a):
    from citeloom.client import Warehouse
    from citeloom.functions import documents, fixed
    from citeloom.operators import catalog as K

    records = K.catalog_papers(Warehouse(spark, a.data).records, list(fixed.CORE_CATEGORIES)).withColumnRenamed("canonical_id", "paper_id")
    links = documents.source_links(F.col("paper_id"), F.col("doi"), F.col("arxiv"), F.col("pmc"), F.col("pubmed"), F.col("open_access_pdf_url"))
    return records.select("paper_id", "title", "year", "venue", "category", "doi", "arxiv", "pubmed", "pmc", "citation_count", links.alias("links"), documents.literal_markdown(F.col("title")).alias("shown_title"), documents.literal_markdown(F.col("venue")).alias("shown_venue"))


def release(spark, a):
    """The public citation graph of the catalogued papers."""
    from citeloom.operators import release as R
    from citeloom.sources import records, writers

    edges = _read(spark, a)("citations.jsonl", records.CITATIONS).select(F.col("from").alias("src"), F.col("to").alias("dst"))
    _show(writers.write_release(*R.public_graph(_catalogued(spark, a), edges), a.folder, a.version))


def audit_prepare(spark, a):
    """Batches of a sample of labelled papers, to be judged again."""
    from citeloom.operators import labels
    from citeloom.sources import records, writers

    log = _read(spark, a)("classifications_7cat.jsonl", records.LABELS)
    drawn = labels.audit_batches(log, sample=a.sample, size=a.size, seed=a.seed)
    meta = records.normalize_papers(_read(spark, a)("discovered_papers.jsonl", records.PAPERS)).groupBy("paper_id").agg(F.min_by(F.struct("title", F.substring("abstract", 1, 600).alias("abstract")), "ord").alias("x")).select("paper_id", "x.*")
    _show({"batches": writers.write_batches(drawn.join(meta, "paper_id", "left"), f"{a.data}/audit_batches", "audit_batch")})


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeloom")
    groups = top.add_subparsers(dest="group", required=True)
    corpus = groups.add_parser("corpus").add_subparsers(dest="command", required=True)
    for name, run in (("build", corpus_build), ("search", corpus_search), ("stats", corpus_stats), ("latest", corpus_latest), ("read", corpus_read)):
        p = corpus.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("index")
        if name == "build":
            p.add_argument("folder")
            p.add_argument("data")
        if name == "search":
            p.add_argument("query")
            p.add_argument("--year-min", type=int)
            p.add_argument("--year-max", type=int)
            for flag in ("--all-versions", "--low-quality", "--back-matter"):
                p.add_argument(flag, action="store_true")
        if name in ("search", "latest"):
            p.add_argument("--limit", type=int, default=10)
            p.add_argument("--category")
        if name == "read":
            p.add_argument("selector")
            p.add_argument("--start", type=int, default=1)
            p.add_argument("--end", type=int)
    ask = groups.add_parser("ask", help="call a method of the warehouse client")
    ask.set_defaults(run=house_call)
    ask.add_argument("data")
    ask.add_argument("command", choices=("resolve_id", "resolve_by_title", "metadata", "cites", "cited_by", "co_cited_with", "papers_in_category", "category_counts", "search_titles", "papers_by_author", "papers_in_venue", "node_stats", "health", "reducer_spec"))
    ask.add_argument("args", nargs="*")
    ask.add_argument("--corpus")
    plain = {"audit": audit, "qc": qc, "build-network": build_network, "init": init, "ingest-seeds": ingest_seeds, "consolidate-seeds": consolidate_seeds, "export": export, "cluster": cluster, "enrich": enrich}
    more = {"backfill-metadata": backfill_metadata, "abstracts": abstracts, "expand": expand, "recursive-expand": recursive_expand, "catalog": catalog, "release": release, "audit-prepare": audit_prepare}
    for name, run in (plain | more).items():
        p = groups.add_parser(name, help=(run.__doc__ or "").split("\n")[0] or None)
        p.set_defaults(run=run)
        p.add_argument("data")
        if name == "backfill-metadata":
            p.add_argument("--dry-run", action="store_true")
        if name == "abstracts":
            p.add_argument("--fetch", action="store_true")
        if name == "expand":
            p.add_argument("edges", help="log of edges that can be reached")
            p.add_argument("--direction", choices=("backward", "forward", "both"), default="backward")
            for option, value in (("--depth", 1), ("--limit", 25), ("--most", 1000)):
                p.add_argument(option, type=int, default=value)
        if name in ("catalog", "release"):
            p.add_argument("folder")
        if name == "release":
            p.add_argument("--version", default="v1")
        if name in ("recursive-expand", "audit-prepare"):
            p.add_argument("--size", type=int, default=50)
        if name == "audit-prepare":
            p.add_argument("--sample", type=int, default=100)
            p.add_argument("--seed", type=int, default=0)
    literature = groups.add_parser("literature").add_subparsers(dest="command", required=True)
    p = literature.add_parser("neighborhood")
    p.set_defaults(run=literature_neighborhood)
    p.add_argument("data")
    p.add_argument("--query", action="append")
    p.add_argument("--paper", action="append")
    p.add_argument("--name")
    p.add_argument("--seeds", type=int, default=1)
    p.add_argument("--limit", type=int, default=25)
    p = literature.add_parser("fetch-arxiv")
    p.set_defaults(run=fetch_arxiv)
    p.add_argument("folder")
    p.add_argument("number")
    for option in ("--title", "--address"):
        p.add_argument(option)
    p.add_argument("--year", type=int)
    c = groups.add_parser("classify").add_subparsers(dest="command", required=True)
    for name in ("prepare", "ingest", "extract-logs", "status"):
        p = c.add_parser(name)
        p.set_defaults(run=classify)
        p.add_argument("data")
        if name == "prepare":
            p.add_argument("--size", type=int, default=50)
        if name in ("ingest", "extract-logs"):
            p.add_argument("path")
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.run(_session(), a)


if __name__ == "__main__":
    main()
