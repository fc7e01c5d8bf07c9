"""Operators in the form that large inputs need: chunks as they are read, records of any kind in one parse, sums over ranges."""

import json
import random
import resource

import pytest
from pyspark.sql import functions as F

from citeloom.functions import documents as D
from citeloom.operators import communities as M
from citeloom.operators import labels as L
from citeloom.sources import records as Rd


def plain_chunks(text, most):
    """Sections and pieces with all lines at hand."""
    path, parts, name, part = [], [], "Document", []
    for number, line in enumerate(text.splitlines(), 1):
        found = D._HEADING.match(line.strip())
        if found:
            if part:
                parts.append((name, part))
            path = [*path[: len(found[1]) - 1], found[2].strip()]
            name, part = " > ".join(path), []
        part.append((number, line))
    if part:
        parts.append((name, part))
    out = []
    for name, part in parts:
        pieces, size = [[]], 0
        for number, line in part:
            if pieces[-1] and size + len(line) + 1 > most:
                pieces.append([])
                size = 0
            pieces[-1].append((number, line))
            size += len(line) + 1
        for piece in pieces:
            body = "\n".join(line for _, line in piece).strip()
            if body:
                out.append((name, piece[0][0], piece[-1][0], body))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_chunks_line_by_line(seed):
    r = random.Random(seed)
    ends = ["\n", "\n\n", "\r\n", "\r", "\x0b", "\x85", " ", "\n# A\n", "\n## B #\n", "\n### C\n", "\n#### D\n   \n", " "]
    text = "".join("word" * r.randrange(0, 9) + r.choice(ends) for _ in range(200))
    for most in (1, 30, 120, 4500):
        assert list(D.chunk_rows(text, most)) == plain_chunks(text, most)
    assert list(D.lines_of(text)) == text.splitlines()


def test_chunk_table(spark):
    texts = [(1, "# A\nx\n" + "y" * 5000 + "\n## B\nz"), (2, ""), (3, None), (4, "a\n" * 5000)]
    docs = spark.createDataFrame(texts, "document_id long, text string").selectExpr("*", "'n' AS heading").repartition(2)
    rows = D.chunk_table(docs).collect()
    for i, text in texts:
        got = [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.chunk_no) if r.document_id == i]
        assert got == [(k, *c) for k, c in enumerate(plain_chunks(text or "", 4500))]


def test_chunks_of_a_very_long_text():
    """200 MB of text take little more than the text itself while its chunks are read."""
    text = ("line of some words\n" * 50 + "# Heading\n") * 210_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(1 for _ in D.chunk_rows(text))
    assert len(text) > 200_000_000 and n == 210_001 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000


def test_records_of_any_kind(spark, tmp_path):
    """Authors as objects, as texts and mixed; ids and numbers as numbers and texts; both spellings of a field."""
    rows = [
        {"paper_id": "a", "title": "T", "year": 2020, "authors": [{"name": "X", "authorId": 7}, "Y", {"name": " "}, "", None], "externalIds": {"DOI": "10.1/a", "CorpusId": 5}, "openAccessPdf": {"url": "u"}, "citationCount": 3},
        {"paper_id": "b", "year": "2021", "authors": ["Y", ""], "external_ids": {"CorpusId": "5", "PubMed": 12}, "s2_paper_id": "h", "citation_count": "4", "open_access_pdf": {"url": "w"}},
        {"paper_id": "", "title": "none"},
        {"title": "no id"},
        {"paper_id": "c", "year": "bad", "corpusId": 9, "doi": "10.1/c", "authors": None, "provenance": {"source": "s", "confidence": 0.5}},
        {"paper_id": 12, "year": None, "authors": "not a list", "abstract": "é"},
    ]
    (tmp_path / "p.jsonl").write_text("\n".join([json.dumps(rows[0]), "", *map(json.dumps, rows[1:])]) + '\n[1]\n{"torn')
    found = {r.paper_id: r for r in Rd.read_papers(spark, f"{tmp_path}/p.jsonl", strict=False).collect()}
    assert set(found) == {"a", "b", "c", "12"}
    a, b, c = (found[k] for k in "abc")
    assert [tuple(x) for x in a.authors] == [("X", "7"), ("Y", None)] and (a.year, a.doi, a.s2, a.open_access_pdf_url, a.citation_count) == (2020, "10.1/a", "5", "u", 3)
    assert [x.name for x in b.authors] == ["Y"] and (b.year, b.s2, b.pubmed, b.s2hash, b.citation_count, b.open_access_pdf_url) == (2021, "5", "12", "h", 4, "w")
    assert (c.year, c.s2, c.doi, c.authors, c.provenance.confidence) == (None, "9", "10.1/c", [], 0.5)
    assert found["12"].authors == [] and found["12"].abstract == "é" and a.ord < b.ord < c.ord
    with pytest.raises(Exception):
        Rd.read_papers(spark, f"{tmp_path}/p.jsonl").collect()
    assert Rd.read_papers(spark, f"{tmp_path}/none.jsonl").collect() == []
    # records of one kind give the rows that the declared schema gives
    (tmp_path / "q.jsonl").write_text("\n".join(map(json.dumps, [rows[1], rows[4], {"paper_id": "d", "authors": [{"name": "X"}], "externalIds": {"ArXiv": "1"}}])) + "\n")
    both = [Rd.read_papers(spark, f"{tmp_path}/q.jsonl"), Rd.normalize_papers(Rd.read_log(spark, f"{tmp_path}/q.jsonl", Rd.PAPERS))]
    assert both[0].columns == both[1].columns
    one, other = (sorted(map(str, df.drop("ord").collect())) for df in both)
    assert one == other


def test_one_parse_a_line(spark, tmp_path, capsys):
    (tmp_path / "p.jsonl").write_text('{"paper_id": "a"}\n')
    rows = Rd.read_papers(spark, f"{tmp_path}/p.jsonl")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.count("parseJson") <= 2 and "from_json" not in plan


def test_prefix_sums(spark):
    """A key with a third of all rows is summed over ranges, in order, as the others are."""
    r = random.Random(2)
    rows = [("hot" if k % 3 == 0 else f"k{k % 40}", r.randrange(1000), k, float(r.randrange(5))) for k in range(3000)]
    df = spark.createDataFrame(rows, "key string, gain int, node int, d double").repartition(6)
    got = {x.node: x.more for x in L.prefix_sums(df, ["key"], [F.desc("gain"), F.col("node")], "d", "more").collect()}
    sums, want = {}, {}
    for key, _, node, d in sorted(rows, key=lambda x: (x[0], -x[1], x[2])):
        want[node] = sums.get(key, 0.0)
        sums[key] = want[node] + d
    assert got == want


def test_numbers_by_one_shuffle(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(1000)], "a int, b int").repartition(5)
    rows = L.numbered(df, [F.desc("a"), F.col("b")]).collect()
    assert [(-r.a, r.b) for r in sorted(rows, key=lambda r: r.place)] == sorted((-(k % 7), k) for k in range(1000))
    assert sorted(r.place for r in rows) == list(range(1000))


@pytest.mark.parametrize("most", [10, 20_000])
def test_communities_are_connected(spark, most):
    """Each community is connected, and together they have the modularity that a sum over all pairs gives."""
    r = random.Random(5)
    edges = {(f"n{a}", f"n{b}") for g in range(6) for a, b in ((g * 15 + r.randrange(15), g * 15 + r.randrange(15)) for _ in range(45)) if a != b}
    edges |= {(f"n{r.randrange(90)}", f"n{r.randrange(90)}") for _ in range(25)} | {(f"n{k}", "hub") for k in range(0, 90, 2)}
    edges = {e for e in edges if e[0] != e[1]}
    df = spark.createDataFrame(sorted(edges), "src string, dst string")
    found = M.communities(df, most).collect()
    of = {x.node: (x.component, x.community) for x in found}
    pairs = {tuple(sorted(e)) for e in edges}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for c in set(of.values()):
        mine = {n for n in of if of[n] == c}
        seen, todo = set(), [min(mine)]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += [x for x in near[n] if x in mine]
        assert seen == mine
    m = len(pairs)
    want = sum(1 / m for a, b in pairs if of[a] == of[b]) - sum(len(near[a]) * len(near[b]) / (2 * m) ** 2 for a in near for b in near if of[a] == of[b])
    members = spark.createDataFrame([(n, f"{c[0]}/{c[1]}") for n, c in of.items()], "node string, community string")
    got = M.modularity(df, members).agg(F.sum("share")).first()[0]
    assert got == pytest.approx(want) and got > 0.3
