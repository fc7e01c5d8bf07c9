"""The workflow around the graph: expansion against a plain queue, pages, release, services with fakes, command line."""

import argparse
import csv
import json
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from citeloom import cli
from citeloom.functions import documents as D
from citeloom.operators import backfill as B
from citeloom.operators import expansion as X
from citeloom.operators import pages as G
from citeloom.operators import release as R
from citeloom.sources import records as Rd
from citeloom.sources import services as Sv
from citeloom.sources import settings as St
from citeloom.sources import writers as Wr


def queue_walk(edges, seeds, known, processed, depth, per_paper, most, direction):
    """The same as one queue, an edge at a time."""
    near = {}
    for src, dst, place in sorted(edges, key=lambda e: e[2]):
        if direction in ("backward", "both"):
            near.setdefault((src, 0), []).append((dst, (src, dst)))
        if direction in ("forward", "both"):
            near.setdefault((dst, 1), []).append((src, (src, dst)))
    queue, visited, old, added, keys = deque((s, 0) for s in seeds), set(seeds), set(known), [], []
    while queue and len(added) < most:
        paper, step = queue.popleft()
        key = f"{direction}:{paper}:{step}"
        if step >= depth or key in processed:
            continue
        for side in (0, 1):
            if len(added) >= most:
                break
            for other, edge in near.get((paper, side), [])[:per_paper]:
                if edge not in old:
                    old.add(edge)
                    added.append(edge)
                if other not in visited:
                    visited.add(other)
                    queue.append((other, step + 1))
                if len(added) >= most:
                    break
        keys.append(key)
    return set(added), set(keys)


@pytest.mark.parametrize("seed, direction", [(1, "backward"), (2, "forward"), (3, "both"), (4, "both"), (5, "backward")])
def test_expansion_as_one_queue(spark, seed, direction):
    r = random.Random(seed)
    pairs = list({(f"n{r.randrange(30)}", f"n{r.randrange(30)}") for _ in range(90)})
    edges = [(a, b, k) for k, (a, b) in enumerate(pairs) if a != b]
    seeds = ["n1", "n2", "n3"]
    known = [e[:2] for e in r.sample(edges, 5)]
    processed = {f"{direction}:n2:0", f"{direction}:n5:1"}
    frames = (
        spark.createDataFrame(edges, "src string, dst string, ord long"), spark.createDataFrame([(s, k) for k, s in enumerate(seeds)], "paper_id string, ord long"),
        spark.createDataFrame(known, "src string, dst string"), spark.createDataFrame([(k,) for k in processed], "key string"),
    )
    for depth, per_paper, most in ((3, 2, 1000), (2, 3, 7), (1, 50, 3), (3, 50, 0)):
        added, keys = X.expand_limited(*frames, depth=depth, per_paper=per_paper, most=most, direction=direction)
        want, marks = queue_walk(edges, seeds, known, processed, depth, per_paper, most, direction)
        assert {tuple(x) for x in added.collect()} == want
        if most:
            assert {x.key for x in keys.collect()} == marks


def test_log_order_over_files(spark, tmp_path):
    """Files of very different sizes are read by tasks in another order than that of their names."""
    (tmp_path / "log").mkdir()
    sizes = [1, 400, 2, 3000, 5]
    for k, n in enumerate(sizes):
        (tmp_path / "log" / f"{k}.jsonl").write_text("".join(json.dumps({"alias": f"{k}", "canonical": f"{i}"}) + "\n" for i in range(n)) + "{torn")
    got = Rd.read_log(spark, f"{tmp_path}/log", Rd.ALIASES, strict=False).orderBy("ord").collect()
    assert [(int(x.alias), int(x.canonical)) for x in got] == [(k, i) for k, n in enumerate(sizes) for i in range(n)]
    assert len({x.ord for x in got}) == len(got)


PAPERS = [
    ("doi:10.1/b", "[New] <b>graphs</b>", 2025, "NeuroImage", "fmri_gnn", "10.1/b"),
    ("doi:10.1/a", "Old?", 2020, "  zeta  letters", "fmri_gnn", "10.1/a"),
    ("x", "Unknown year", None, None, "fmri_geometric_manifold", None),
    ("y", "Left out", 2020, "V", "fmri_no_graph", None),
]


def catalogued(spark):
    rows = spark.createDataFrame(PAPERS, "paper_id string, title string, year int, venue string, category string, doi string")
    none = F.lit(None).cast("string")
    links = D.source_links(F.col("paper_id"), F.col("doi"), none, none, none, none)
    return rows.select("*", links.alias("links"), D.literal_markdown(F.col("title")).alias("shown_title"), D.literal_markdown(F.col("venue")).alias("shown_venue"))


def test_catalog_pages(spark, tmp_path):
    papers = catalogued(spark)
    lines = G.page_lines(papers).unionByName(G.index_lines(papers))
    assert Wr.write_pages(lines, str(tmp_path)) == 14
    gnn = (tmp_path / "fmri_gnn.md").read_text()
    assert gnn.index("## 2025") < gnn.index("## 2020") and "- \\[New\\] graphs — NeuroImage. [DOI](https://doi.org/10.1/b)" in gnn and "- Old? — zeta letters. [DOI]" in gnn
    assert "Source link pending" in (tmp_path / "fmri_geometric_manifold.md").read_text()
    assert "## Year unknown" in (tmp_path / "by_source" / "pending.md").read_text() and (tmp_path / "by_year" / "unknown.md").exists()
    assert "[N](n.md)" in (tmp_path / "by_venue" / "README.md").read_text() and "## zeta letters (1)" in (tmp_path / "by_venue" / "z.md").read_text()
    assert "| [2025](2025.md) | 1 | 1 | 0 | 0 |" in (tmp_path / "by_year" / "README.md").read_text()
    assert "Left out" not in "".join(p.read_text() for p in tmp_path.rglob("*.md"))
    # pages that are no more go; one edited by hand stops all
    (tmp_path / "by_year" / "1999.md").write_text(Wr.MARKER)
    Wr.write_pages(lines, str(tmp_path))
    assert not (tmp_path / "by_year" / "1999.md").exists()
    (tmp_path / "by_year" / "2020.md").write_text("Human note")
    with pytest.raises(FileExistsError):
        Wr.write_pages(lines, str(tmp_path))
    assert (tmp_path / "by_year" / "2020.md").read_text() == "Human note"


def test_release(spark, tmp_path):
    edges = spark.createDataFrame([("doi:10.1/a", "doi:10.1/b"), ("doi:10.1/a", "doi:10.1/b"), ("x", "x"), ("x", "y"), (None, "x")], "src string, dst string")
    nodes, kept, stats = R.public_graph(catalogued(spark), edges)
    found = Wr.write_release(nodes, kept, stats, str(tmp_path))
    assert (found["nodes"], found["edges"], found["isolated_nodes"], found["self_loops_removed"], found["components"], found["largest"]) == (3, 1, 1, 1, 2, 2)
    with open(tmp_path / "nodes.csv", encoding="utf-8") as f:
        rows = list(csv.DictReader(f))
    assert [r["paper_id"] for r in rows] == ["doi:10.1/a", "doi:10.1/b", "x"] and list(rows[0]) == "paper_id,title,year,venue,category,doi,arxiv,pubmed,pmc,citation_count".split(",")
    assert rows[2]["year"] == "" and rows[0]["doi"] == "10.1/a"
    with open(tmp_path / "edges.csv", encoding="utf-8") as f:
        assert list(csv.DictReader(f)) == [{"source": "doi:10.1/a", "target": "doi:10.1/b", "relation": "cites"}]
    assert len((tmp_path / "SHA256SUMS").read_text().splitlines()) == 5 and json.loads((tmp_path / "stats.json").read_text()) == found
    placed = nodes.select("paper_id", "title", "year", "venue", "category").withColumns({"x": F.lit(1.5), "y": F.lit(2.0), "size": F.lit(3.0), "degree": F.lit(1)})
    Wr.write_web_graph(placed, kept, f"{tmp_path}/network.json")
    web = json.loads((tmp_path / "network.json").read_text())
    assert [n["paper_id"] for n in web["nodes"]] == ["doi:10.1/a", "doi:10.1/b", "x"] and web["edges"] == [[0, 1]]


def test_settings(spark, tmp_path):
    assert "papers.jsonl" in St.scaffold(str(tmp_path), [{"query": "graph fMRI", "tag": "t"}, {"tag": "none"}]) and St.scaffold(str(tmp_path)) == []
    assert [tuple(r) for r in St.read_seeds(spark, f"{tmp_path}/seeds.yaml").collect()] == [("graph fMRI", "t", 0)]
    (tmp_path / "own.yaml").write_text("confidence: 0.9\nstorage: {data: d}\nother: 1\n")
    assert St.read_settings(f"{tmp_path}/own.yaml") == {"storage": {"data": "d", "cache": "cache"}, "calls_a_minute": St.DEFAULTS["calls_a_minute"], "confidence": 0.9, "other": 1}
    members = spark.createDataFrame([("a", 0, 1), ("b", 0, 1)], "node string, component int, community int")
    summary = spark.createDataFrame([(0, 1, 2, ["V"], None)], "component int, community int, size long, top_venues array<string>, top_keywords array<string>")
    assert St.write_clusters(St.clusters_of(summary, members), f"{tmp_path}/c.yaml", f"{tmp_path}/c.md") == 1
    assert sorted(map(tuple, St.read_clusters(spark, f"{tmp_path}/c.yaml").collect())) == [("a", "c0_1"), ("b", "c0_1")]
    assert St.read_clusters(spark, f"{tmp_path}/none.yaml").collect() == []


def paper(n, **more):
    return {"paperId": f"S{n}", "corpusId": n, "title": f"Graph paper {n}", "year": 2000 + n, "venue": "V", "authors": [{"name": "A B"}], "externalIds": {"CorpusId": n, **more}, "citationCount": n}


def fake(service):
    """A service with a few papers: a search finds 1, which cites 2 and 3 and is cited by 4; one neighbour has no title."""

    def make():
        def get(path, params):
            if path.endswith("/references"):
                return {"data": [{"citedPaper": paper(2)}, {"citedPaper": paper(3, DOI="10.1/Three")}, {"citedPaper": {**paper(9), "title": None}}]}
            if path.endswith("/citations"):
                return {"data": [{"citingPaper": paper(4)}]}
            if path == "/paper/search":
                return {"data": [paper(1)] if params["query"] == "graph fMRI" else []}
            if service == "openalex" and path == "/works":
                return {"results": [{"id": "https://openalex.org/W5", "title": "Work 5", "publication_year": 2005, "doi": "https://doi.org/10.1/five", "authorships": []}]}
            if service == "crossref":
                return {"message": {"title": ["T"], "container-title": ["C"], "issued": {"date-parts": [[2011, 2]]}}}
            if service == "doi":
                return {"abstract": "<p>Of a DOI</p>"} if path == "/10.1/five" else None
            if service == "europe_pmc":
                return {"resultList": {"result": [{"doi": "10.9/X", "title": "Another", "abstractText": "no"}, {"title": "Graph paper 1!", "abstractText": "<i>Found</i> by title"}]}}
            return paper(1)

        return get

    return make


def test_cached_answers(tmp_path):
    asked = []

    def get(path, params):
        asked.append((path, params))
        return {"n": len(asked)} if path != "/none" else None

    kept = Sv.cached(get, f"{tmp_path}/cache", "s2_")
    assert [kept("/a", {"q": "x"}), kept("/a", {"q": "x"}), kept("/a", {"q": "y"}), kept("/none", {}), kept("/none", {})] == [{"n": 1}, {"n": 1}, {"n": 2}, None, None]
    files = sorted((tmp_path / "cache").glob("s2_*.json"))
    assert len(files) == 2 and len(asked) == 4
    files[0].write_text("{torn")
    assert {kept("/a", {"q": "x"})["n"], kept("/a", {"q": "y"})["n"]} & {5}


def rows_of(path):
    return [json.loads(x) for x in path.read_text().splitlines()]


def test_commands_with_services(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(Sv, "CALLS_A_MINUTE", dict.fromkeys(("semantic_scholar", "openalex", "crossref", "europe_pmc", "doi"), 1e6))
    data = tmp_path / "w"
    St.scaffold(str(data), [{"query": "graph fMRI", "tag": "t"}, {"query": "unknown", "tag": None}])
    ns = lambda **more: argparse.Namespace(data=str(data), **more)
    for _ in range(2):  # a second run adds nothing
        cli.ingest_seeds(spark, ns(), fake)
        papers = rows_of(data / "papers.jsonl")
        assert sorted(p["paper_id"] for p in papers) == ["doi:10.1/five", "s2:1"]
    assert {p["paper_id"]: p.get("seed_tag") for p in papers} == {"doi:10.1/five": None, "s2:1": "t"}
    assert all(p["provenance"]["confidence"] == 0.7 for p in papers)
    cli.enrich(spark, ns(), fake)
    assert [(p["paper_id"], p["title"], p["venue"], p["provenance"]["source"]) for p in rows_of(data / "papers.jsonl")[2:]] == [("doi:10.1/five", "Work 5", "C", "crossref")]
    cli.abstracts(spark, ns(fetch=True), fake)
    assert sorted((r["paper_id"], r["abstract"], r["source"]) for r in rows_of(data / "abstracts.jsonl")) == [("doi:10.1/five", "Of a DOI", "doi_csl"), ("s2:1", "Found by title", "europe_pmc_title")]
    (data / "classifications_7cat.jsonl").write_text(json.dumps({"paper_id": "s2:1", "category": "fmri_gnn"}) + "\n" + json.dumps({"paper_id": "s2:2", "category": "out_of_scope"}) + "\n")
    cli.recursive_expand(spark, ns(size=50), fake)
    assert sorted((r["from"], r["to"]) for r in rows_of(data / "citations.jsonl")) == [("s2:1", "doi:10.1/three"), ("s2:1", "s2:2"), ("s2:4", "s2:1")]
    assert sorted(r["paper_id"] for r in rows_of(data / "discovered_papers.jsonl")) == ["doi:10.1/three", "s2:2", "s2:4"][0::2]
    assert [(r["paper_id"], r["n_refs"], r["n_cites"]) for r in rows_of(data / "expansion_state.jsonl")] == [("s2:1", 3, 1)]
    assert [p["paper_id"] for p in json.loads((data / "expand_classify_batches" / "batch_0000.json").read_text())] == ["doi:10.1/three", "s2:4"]
    before = (data / "citations.jsonl").read_text()
    cli.recursive_expand(spark, ns(size=50), fake)  # what was expanded isn't asked for again
    assert (data / "citations.jsonl").read_text() == before
    cli.literature_neighborhood(spark, ns(query=["graph fMRI"], paper=None, name="n", seeds=1, limit=25), fake)
    folder = data / "literature_neighborhoods"
    nodes, edges = rows_of(folder / "n.nodes.jsonl"), rows_of(folder / "n.edges.jsonl")
    assert {n["paper_id"]: n["roles"] for n in nodes} == {"S1": ["seed"], "S2": ["reference"], "S3": ["reference"], "S9": ["reference"], "S4": ["citation"]}
    assert {(e["source"], e["target"], e["relation"]) for e in edges} >= {("S1", "S2", "references"), ("S4", "S1", "citations")}
    assert all(f"Graph paper {k}" in (folder / "n.md").read_text() for k in (1, 2, 4))
    with pytest.raises(ValueError):
        cli.literature_neighborhood(spark, ns(query=None, paper=None, name="n", seeds=1, limit=25), fake)
    capsys.readouterr()


def test_commands_on_logs(spark, tmp_path, capsys):
    data = tmp_path / "w"
    St.scaffold(str(data))
    ns = lambda **more: argparse.Namespace(data=str(data), **more)
    lines = lambda name, rows: (data / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    lines("papers.jsonl", [{"paper_id": "a", "title": "Graph networks of brains", "openalex_id": "https://openalex.org/W1"}, {"paper_id": "b", "title": "EEG only", "venue": "V"}, {"paper_id": "c", "title": "C", "year": 2001, "venue": "V"}])
    lines("citations.jsonl", [{"from": "a", "to": "b"}, {"from": "b", "to": "c"}, {"from": "c", "to": "a"}])
    lines("haiku_classifications.jsonl", [{"paper_id": "a", "is_fmri_gnn": True}, {"paper_id": "b", "is_fmri_gnn": True}, {"paper_id": "z", "is_fmri_gnn": False}])
    lines("reachable.jsonl", [{"from": "a", "to": "n1"}, {"from": "a", "to": "n2"}, {"from": "n1", "to": "n3"}])
    lines("classifications_7cat.jsonl", [{"paper_id": x, "category": "fmri_gnn"} for x in "abc"])
    (data / "cache" / "oa_1.json").write_text(json.dumps({"id": "https://openalex.org/W1", "publication_year": 2009, "primary_location": {"source": {"display_name": "NI"}}, "abstract_inverted_index": {"b": [1], "a": [0]}}))
    cli.consolidate_seeds(spark, ns())
    assert [r["paper_id"] for r in rows_of(data / "confirmed_seeds.jsonl")] == ["a"]
    cli.backfill_metadata(spark, ns(dry_run=False))
    assert [(r["paper_id"], r["year"], r["venue"], r["provenance"]["source"]) for r in rows_of(data / "papers.jsonl")[3:]] == [("a", "2009", "NI", "openalex_cache")]
    cli.abstracts(spark, ns(fetch=False))
    assert [(r["paper_id"], r["abstract"]) for r in rows_of(data / "abstracts.jsonl")] == [("a", "a b")]
    for _ in range(2):  # a second run finds all keys worked
        cli.expand(spark, ns(edges="reachable.jsonl", direction="backward", depth=1, limit=5, most=10))
    assert len(rows_of(data / "citations.jsonl")) == 5
    cli.cluster(spark, ns())
    assert "papers" in (data / "notes" / "cluster-summaries.md").read_text()
    cli.export(spark, ns())
    assert (data / "graph" / "network.graphml").read_text().count("<edge ") == 5
    cli.catalog(spark, ns(folder=f"{tmp_path}/pages"))
    cli.release(spark, ns(folder=f"{tmp_path}/public", version="v1"))
    assert json.loads((tmp_path / "public" / "stats.json").read_text())["edges"] == 3
    cli.audit_prepare(spark, ns(sample=2, size=1, seed=3))
    assert len(list((data / "audit_batches").glob("audit_batch_*.json"))) == 2
    page = "<h1>T</h1><p>" + "word " * 400 + "</p>"
    answers = {"https://arxiv.org/html/2301.1": (404, page), "https://ar5iv.labs.arxiv.org/html/2301.1": (200, page)}
    for year in (None, 2023):
        cli.fetch_arxiv(spark, argparse.Namespace(folder=f"{tmp_path}/corpus", number="arXiv:2301.1", title=None, address=None, year=year), answers.__getitem__)
    index = rows_of(tmp_path / "corpus" / "INDEX.jsonl")
    assert len(index) == 1 and index[0]["year"] == 2023 and "# T" in (tmp_path / "corpus" / index[0]["fulltext_file"]).read_text()
    with pytest.raises(LookupError):
        Sv.arxiv_page(lambda _: (200, "short"), "1")
    capsys.readouterr()


def test_cx_and_mirror(spark, tmp_path):
    nodes = spark.createDataFrame([("b", "B", 2001), ("a", None, None)], "paper_id string, title string, year int")
    edges = spark.createDataFrame([("b", "a"), ("a", "gone")], "src string, dst string")
    Wr.write_cx(nodes, edges, f"{tmp_path}/g.cx", "G")
    cx = {k: v for aspect in json.loads((tmp_path / "g.cx").read_text()) for k, v in aspect.items()}
    assert [n["n"] for n in cx["nodes"]] == ["a", "B"] and [(e["s"], e["t"]) for e in cx["edges"]] == [(1, 0)] and cx["nodeAttributes"] == [{"po": 1, "n": "year", "v": "2001"}]
    where = str(tmp_path / "sent")

    def client():
        def run(statement, rows):
            with open(where, "a", encoding="utf-8") as out:
                out.write("".join(f"{statement} {r['paper_id']}\n" for r in rows))

        return run

    Wr.upserted(nodes, client, "MERGE", size=1)
    assert sorted(open(where, encoding="utf-8").read().split("\n"))[1:] == ["MERGE a", "MERGE b"]


def test_phases_ask_for_what_is_left(spark):
    papers = spark.createDataFrame([("a",), ("b",), ("c",)], "paper_id string")
    asked = []

    def phase(name, known):
        def run(rows):
            asked.append((name, sorted(r.paper_id for r in rows.collect())))
            return rows.where(F.col("paper_id").isin(known)).withColumn("abstract", F.lit(f"<b>{name}</b>"))

        return run

    tried = spark.createDataFrame([("two:c",)], "key string")
    found = B.in_phases(papers, tried, [("one", phase("one", ["a"])), ("two", phase("two", ["b", "c"])), ("three", phase("three", ["c"]))])
    assert sorted(map(tuple, found.collect())) == [("a", "one", "one"), ("b", "two", "two"), ("c", "three", "three")]
    assert asked == [("one", ["a", "b", "c"]), ("two", ["b"]), ("three", ["c"])]


def test_network_files(spark, tmp_path, capsys):
    """Edges keep the relation and source of their first row; the statistics have the names of the file that others read."""
    data = tmp_path / "w"
    St.scaffold(str(data))
    lines = lambda name, rows: (data / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    lines("papers.jsonl", [{"paper_id": x, "title": x.upper()} for x in "abc"])
    lines("citations.jsonl", [{"from": "a", "to": "b", "relation": "references", "source": "s2"}, {"from": "a", "to": "b", "source": "later"}, {"from": "b", "to": "x"}, {"from": "x", "to": "y"}])
    lines("classifications_7cat.jsonl", [{"paper_id": "a", "category": "fmri_gnn"}, {"paper_id": "b", "category": "fmri_gnn"}])
    cli.build_network(spark, argparse.Namespace(data=str(data)))
    edges = sorted((r["from"], r["to"], r["relation"], r["source"]) for r in map(lambda r: r.asDict(), spark.read.json(f"{data}/network/edges").collect()))
    assert edges == [("a", "b", "references", "s2"), ("b", "x", "cites", None)]
    stats = json.loads((data / "network" / "network_stats.json").read_text())
    assert stats["nodes"] == {"total": 3, "core": 2, "secondary": 0, "boundary": 1} and stats["edges"] == {"total": 2, "deduplicated": True}
    assert stats["components"] == {"total": 1, "largest": 3, "isolated": 0} and sum(stats["category_distribution"].values()) == 3 and stats["built_at"]
    capsys.readouterr()


def test_abstracts_that_were_tried(spark, tmp_path, capsys):
    """A second run asks for nothing that the first one asked for, whether it was found or not."""
    data, log = tmp_path / "w", tmp_path / "log"
    St.scaffold(str(data))
    log.mkdir()
    (data / "papers.jsonl").write_text("".join(json.dumps({"paper_id": x, "title": f"A long title of {x}", "doi": f"10.1/{x}"}) + "\n" for x in "ab"))

    def transport(service):
        def make():
            def get(path, params):
                import uuid

                (log / uuid.uuid4().hex).write_text(path)
                return {"abstract": "Found"} if path.endswith("/a") else {}

            return get

        return make

    for calls in (3, 3):  # two DOIs, and a title for the one without an answer
        cli.abstracts(spark, argparse.Namespace(data=str(data), fetch=True), transport)
        assert len(list(log.iterdir())) == calls
    assert [r["paper_id"] for r in rows_of(data / "abstracts.jsonl")] == ["a"]
    capsys.readouterr()
