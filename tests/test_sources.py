"""Readers, writers, services and streams."""

import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from citeloom.sources import records as Rd
from citeloom.sources import services as Sv
from citeloom.sources import writers as Wr
from citeloom.streaming import logs as St


def write(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")


def test_logs(spark, tmp_path):
    write(tmp_path / "a.jsonl", {"alias": "a", "canonical": "b"}, "", {"alias": "c", "canonical": "d"}, '{"alias": "torn')
    rows = Rd.read_log(spark, f"{tmp_path}/a.jsonl", Rd.ALIASES, strict=False).orderBy("ord").collect()
    assert [(r.alias, r.canonical) for r in rows] == [("a", "b"), ("c", "d")]
    with pytest.raises(Exception):
        Rd.read_log(spark, f"{tmp_path}/a.jsonl", Rd.ALIASES).collect()
    assert Rd.read_log(spark, f"{tmp_path}/none.jsonl", Rd.ALIASES).collect() == []


def test_papers_of_several_spellings(spark, tmp_path):
    write(
        tmp_path / "p.jsonl",
        {"paper_id": "a", "title": "T", "year": 2020, "authors": [{"name": "X"}, {"name": " "}], "externalIds": {"DOI": "10.1/a"}, "openAccessPdf": {"url": "u"}, "citationCount": 3},
        {"paper_id": "b", "year": "2021", "authors": ["Y", ""], "external_ids": {"CorpusId": "5"}, "s2_paper_id": "h"},
        {"paper_id": "", "title": "none"},
        {"paper_id": "c", "year": "bad", "corpusId": 9, "doi": "10.1/c"},
    )
    rows = {r.paper_id: r for r in Rd.normalize_papers(Rd.read_log(spark, f"{tmp_path}/p.jsonl", Rd.PAPERS)).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].year, rows["a"].doi, rows["a"].open_access_pdf_url, rows["a"].citation_count, [x.name for x in rows["a"].authors]) == (2020, "10.1/a", "u", 3, ["X"])
    assert (rows["b"].year, rows["b"].s2, rows["b"].s2hash, [x.name for x in rows["b"].authors]) == (2021, "5", "h", ["Y"])
    assert (rows["c"].year, rows["c"].s2, rows["c"].doi, rows["c"].authors) == (None, "9", "10.1/c", [])


def test_files(spark, tmp_path):
    (tmp_path / "batch_0001.json").write_text(json.dumps([{"paper_id": "a", "title": "t"}, {"paper_id": "b"}]))
    assert sorted((r.file, r.paper_id) for r in Rd.read_batches(spark, f"{tmp_path}/batch_*.json").collect()) == [("batch_0001.json", "a"), ("batch_0001.json", "b")]
    (tmp_path / "batch_0000.json").write_text(json.dumps([{"paper_id": f"x{k:03}"} for k in range(200)]))
    ordered = Rd.read_batches(spark, f"{tmp_path}/batch_*.json").orderBy("ord").collect()
    assert [r.paper_id for r in ordered] == [f"x{k:03}" for k in range(200)] + ["a", "b"]
    assert Rd.read_batches(spark, f"{tmp_path}/no_*.json").collect() == []
    for _ in range(2):
        Wr.mark_keys(spark.createDataFrame([("k1",), ("k2",), ("k1",), (None,)], "key string").where("key is not null"), f"{tmp_path}/keys")
    assert sorted(r.key for r in Wr.known_keys(spark, f"{tmp_path}/keys").collect()) == ["k1", "k2"] and spark.read.parquet(f"{tmp_path}/keys").count() == 2
    (tmp_path / "cache" / "d").mkdir(parents=True)
    (tmp_path / "cache" / "d" / "x.md").write_bytes(b"# T\n\xff")
    (row,) = Rd.read_markdown(spark, f"{tmp_path}/cache").collect()
    assert row.source_path == "d/x.md" and row.text.startswith("# T\n")


def test_answers(spark):
    texts = ['say [{"paper_id": "a", "category": "1"}] done', 'x\n{"paper_id": "b", "category": "2"}\n{"id": "c", "category": "3"}\nend', "nothing"]
    got = Rd.answers_in_text(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted((r.paper_id or r.id, r.category) for r in got) == [("a", "1"), ("b", "2"), ("c", "3")]
    lines = [json.dumps({"paper_id": "a", "category": "x"}), json.dumps({"message": {"content": 'ok\\n{"paper_id": "b", "category": "y"}\\nbye'}}), "junk", json.dumps({"paper_id": "c"})]
    assert sorted(map(tuple, Rd.answers_in_logs(spark.createDataFrame([(x,) for x in lines], "value string")).collect())) == [("a", "x"), ("b", "y")]


def test_pace_and_retries():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    # half a minute's worth is saved up, also after a long rest
    pace = Sv.Pace(60, clock=lambda: now[0], sleep=sleep)
    for rest in (0, 1000):
        now[0] += rest
        slept.clear()
        for _ in range(32):
            pace.wait()
        assert len(slept) == 2 and all(abs(s - 1) < 1e-6 for s in slept)
    slow = Sv.Pace(1, clock=lambda: now[0], sleep=sleep)
    slept.clear()
    slow.wait()
    slow.wait()
    assert len(slept) == 1 and abs(slept[0] - 60) < 1e-6
    calls = []

    def failing(path, params):
        calls.append(path)
        if len(calls) < 3:
            raise OSError
        return {"ok": 1}

    assert Sv.fetch(failing, "p", {}, sleep=lambda s: None) == {"ok": 1} and len(calls) == 3
    assert [Sv.delay(k, lambda: 0.5) for k in range(6)] == [0.5, 1, 2, 4, 8, 8]


def test_services(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")

    def transport():
        record = {"title": "T", "year": 2020, "venue": "V", "authors": [{"name": "X"}], "corpusId": 7, "externalIds": {"DOI": "10.1/x"}}
        return lambda path, params: {"a": record} if "a" in params["ids"] else {}

    found = Sv.looked_up(ids, "id", "semantic_scholar", transport)
    (row,) = Sv.standardize_s2(found).collect()
    assert (row.id, row.title, row.authors, row.doi, row.corpus_id) == ("a", "T", ["X"], "10.1/x", "7")
    work = json.dumps({"id": "W1", "title": "O", "publication_year": 2001, "primary_location": {"source": {"display_name": "P"}}, "authorships": [{"author": {"display_name": "Z"}}]})
    (row,) = Sv.standardize_openalex(spark.createDataFrame([("w", work)], "id string, record string")).collect()
    assert (row.venue, row.authors, row.openalex_id, row.year) == ("P", ["Z"], "W1", 2001)
    asked = []

    def phase(known):
        def run(left):
            asked.append(sorted(r.id for r in left.collect()))
            return left.withColumn("value", F.when(F.col("id").isin(*known), F.col("id")))

        return run

    got = Sv.first_found(ids.where("id is not null").distinct(), [phase(["a"]), phase(["a", "b"])]).collect()
    assert sorted((r.id, r.phase) for r in got) == [("a", 0), ("b", 1)] and asked == [["a", "b"], ["b"]]


def graph(spark):
    nodes = spark.createDataFrame([("a", "A & <b>", "fmri_gnn", 1.0, 2.0, 3.0, None), ("b", None, None, 0.0, 0.0, 2.0, 5)], "paper_id string, title string, category string, x double, y double, size double, n int")
    return nodes, spark.createDataFrame([("a", "b")], "src string, dst string")


def test_graph_files(spark, tmp_path):
    nodes, edges = graph(spark)
    assert Wr.write_graphml(nodes, edges, f"{tmp_path}/g.graphml") == 1
    tree = ET.parse(tmp_path / "g.graphml").getroot()
    ns = {"g": "http://graphml.graphdrawing.org/xmlns"}
    assert [n.get("id") for n in tree.findall(".//g:node", ns)] == ["a", "b"]
    assert {d.get("key"): d.text for d in tree.find(".//g:node[@id='a']", ns)} == {"title": "A & <b>", "category": "fmri_gnn", "x": "1.0", "y": "2.0", "size": "3.0"}
    Wr.write_gexf(nodes, edges, f"{tmp_path}/g.gexf", {"fmri_gnn": (1, 2, 3)})
    assert ET.parse(tmp_path / "g.gexf").getroot().get("version") == "1.2"
    Wr.write_cx(nodes, edges, f"{tmp_path}/g.cx", "name")
    cx = json.loads((tmp_path / "g.cx").read_text())
    assert cx[1]["nodes"][0] == {"@id": 0, "n": "A & <b>", "r": "a"} and cx[2]["edges"] == [{"@id": 0, "s": 0, "t": 1, "i": "cites"}]
    Wr.write_csv(nodes.select("paper_id", "title", "n"), f"{tmp_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()
    assert sorted((r.paper_id, r.title, r.n) for r in back) == [("a", "A & <b>", None), ("b", None, "5")]
    import hashlib

    (row,) = Wr.checksums(spark, [f"{tmp_path}/g.cx"]).collect()
    assert row.name == "g.cx" and row.sha256 == hashlib.sha256((tmp_path / "g.cx").read_bytes()).hexdigest()


def test_pages(tmp_path):
    folder = str(tmp_path)
    Wr.sync_pages(folder, {"a.md": "x", "b.md": "y"})
    Wr.sync_pages(folder, {"a.md": "z"})
    assert not (tmp_path / "b.md").exists() and "z" in (tmp_path / "a.md").read_text()
    (tmp_path / "a.md").write_text("by hand")
    with pytest.raises(FileExistsError):
        Wr.write_page(f"{folder}/a.md", "new")


def test_inserts(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    assert sorted(map(tuple, Wr.insert_new(rows, spark.createDataFrame([("b",)], "k string"), ["k"], F.col("v")).collect())) == [("a", 1)]
    record = spark.createDataFrame([("A", 9)], "paper_id string, v int")
    old = spark.createDataFrame([("a", 1), ("c", 2)], "paper_id string, v int")
    assert sorted(map(tuple, Wr.replaced(old, record).collect())) == [("A", 9), ("c", 2)]


def test_streams(spark, tmp_path):
    schema = "paper_id string, category string, tier int, classified_at string, confidence string, is_core boolean, ord long"
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "1.json", {"paper_id": "a", "category": "x", "tier": 3, "classified_at": "2020", "ord": 0}, {"paper_id": "b", "category": "y", "tier": 1, "classified_at": "2020", "ord": 1})
    write(tmp_path / "in" / "2.json", {"paper_id": "a", "category": "z", "tier": 1, "classified_at": "2024", "ord": 2}, {"paper_id": "b", "category": "w", "tier": 2, "classified_at": "2010", "ord": 3}, "{torn")
    seen = []
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)

    def again(checkpoint, done):
        new = St.process_new(St.stream_log(spark, f"{tmp_path}/in", schema), f"{tmp_path}/{done}", "paper_id", lambda df: seen.append(sorted(r.paper_id for r in df.collect())))
        new.option("checkpointLocation", f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()

    again("ck3", "done")
    assert seen[0] == ["a", "b"]
    # the same run goes on with new keys alone, another one leaves out what was marked before it began
    write(tmp_path / "in" / "3.json", {"paper_id": "b", "category": "q"}, {"paper_id": "c", "category": "q"})
    again("ck3", "done")
    assert seen[-1] == ["c"]
    write(tmp_path / "in" / "4.json", {"paper_id": "d", "category": "q"})
    again("ck4", "done")
    assert seen[-1] == ["d"]
    spark.conf.set("spark.sql.shuffle.partitions", width)


def test_event_windows(spark, tmp_path):
    spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 3.0)], "event_type string, value double").withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp")).write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("event_type string, value double, ts timestamp").parquet(f"{tmp_path}/e")
    run = St.event_windows(stream).writeStream.format("memory").queryName("windows").outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start()
    run.awaitTermination()
    assert {(r.event_type, r.n, r.value) for r in spark.table("windows").collect()} == {("x", 2, 3.0), ("y", 1, 3.0)}
