"""Scalar functions against hand-made cases and plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from citeloom.functions import documents as D
from citeloom.functions import fixed, terms
from citeloom.functions import text as T


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_dois(spark):
    raw = [("https://doi.org/10.1/ABC",), (" http://dx.doi.org/10.1/x ",), ("doi:10.1/doi:y",), ("DOI:10.2/Z",), (None,)]
    assert values(spark, raw, "d string", T.normalize_doi(F.col("d"))) == [("10.1/abc",), ("10.1/x",), ("10.1/y",), ("10.2/z",), (None,)]
    assert values(spark, raw, "d string", T.lookup_doi(F.col("d"))) == [("10.1/abc",), ("http://dx.doi.org/10.1/x",), ("10.1/doi:y",), ("10.2/z",), (None,)]


def test_titles(spark):
    rows = [("  Graph-Nets:  A Study!  ",), ("É und ß",), ("",)]
    assert values(spark, rows, "t string", T.normalize_title(F.col("t")), T.title_key(F.col("t"))) == [
        ("graphnets a study", "graph nets a study"),
        (" und ", "und"),
        ("", ""),
    ]
    assert values(spark, [("The brain and the Brain network of mice in 3d",)], "t string", F.array_sort(T.title_tokens(F.col("t")))) == [(["brain", "mice"],)]
    assert D.loose_title("  Café—Title:  x ") == "cafetitle x" and D.loose_title(None) == ""


def test_canonical_id(spark):
    rows = [("10.1/A", "5", "W1", "t", 2000, "X"), ("", "5", "W1", "t", 2000, "X"), (None, None, "W1", "t", 2000, "X"), (None, None, None, "A Title!", 2001, "Jane D."), (None, None, None, None, None, None)]
    got = [r[0] for r in values(spark, rows, "d string, c string, o string, t string, y int, a string", T.canonical_id(*map(F.col, "dcotya")))]
    import hashlib

    assert got[:3] == ["doi:10.1/a", "s2:5", "oa:W1"]
    assert got[3] == "hash:" + hashlib.sha1(b"a title|2001|janed").hexdigest()[:12]
    assert got[4].startswith("hash:")


def test_paths(spark):
    rows = [("doi_10.1000_Example_x.manual/paper.md",), ("s2_ABC/p.md",), ("Other.Name/p.md",), ("doi_10.48550_arxiv.2301.00001/p.md",), ("plain",)]
    assert values(spark, rows, "p string", *T.identity_from_path(F.col("p"))) == [
        ("doi:10.1000/example_x", "doi:10.1000/example_x", "manual"),
        ("s2:abc", "s2:abc", "unknown"),
        ("other.name", "", "unknown"),
        ("doi:10.48550/arxiv.2301.00001", "doi:10.48550/arxiv.2301.00001", "unknown"),
        ("plain", "", "unknown"),
    ]


def test_evidence(spark):
    long = "word " * 3000
    rows = [
        ("x", "t", "drive", "ready"),
        ("x" * 1999, "t", "yearly", "short"),
        ("References & Citations " + "y " * 2000 + "Loading...", "t", "yearly", "stub"),
        ("Current browse context " + "y " * 2000, "t", "yearly", "stub"),
        ("CAPTCHA " + "y " * 2000, "t", "yearly", "blocked"),
        ("# Other things\n" + long, "Graph neural networks brain", "yearly", "title_mismatch"),
        ("# Graph neural networks\n" + long, "Graph neural networks brain", "yearly", "ready"),
        ("y " * 2000, "t", "yearly", "thin"),
        ("# Abstract\n" + "y " * 2000 + "\n## Results\nz", "t", "yearly", "ready"),
    ]
    got = values(spark, rows, "x string, t string, o string, want string", T.evidence_status(F.col("x"), F.col("t"), F.col("o")), "want")
    assert [a for a, _ in got] == [b for _, b in got]


def test_back_matter(spark):
    rows = [("References",), ("Results > references",), ("A > References > Notes",), ("References > Notes",), ("Preferences",), ("Results",)]
    assert [r[0] for r in values(spark, rows, "h string", T.back_matter(F.col("h")))] == [True, True, True, False, False, False]


def test_small_functions(spark):
    rows = [(None, 1), ("  ", 2), ("Nature  Methods ", 3), ("9th venue", 4), ("ähnlich", 5)]
    assert values(spark, rows, "v string, k int", T.venue_name(F.col("v")), T.venue_bucket(T.venue_name(F.col("v")))) == [
        ("Unknown venue", "unknown"), ("Unknown venue", "unknown"), ("Nature Methods", "n"), ("9th venue", "0-9"), ("ähnlich", "other"),
    ]
    assert values(spark, [("a" * 70,), ("b",)], "t string", T.short_label(F.col("t"))) == [("a" * 60 + "...",), ("b",)]
    assert values(spark, [({"b": [1], "a": [0, 2]},), ({},)], "m map<string,array<int>>", T.abstract_of(F.col("m"))) == [("a b a",), (None,)]
    assert values(spark, [("1",), (" FMRI_network_analysis ",), ("7",), ("nonsense",), (None,)], "c string", T.category_of_answer(F.col("c"))) == [
        ("fmri_gnn",), ("fmri_no_graph",), ("out_of_scope",), ("out_of_scope",), ("out_of_scope",),
    ]
    assert values(spark, [("tda_brain",), ("new_thing",), (None,)], "c string", T.legacy_category(F.col("c"))) == [("fmri_geometric_manifold",), ("out_of_scope",), (None,)]
    assert values(spark, [("An EEG study", "x"), ("EEG", "and resting-state data"), ("rs-fMRI EEG", None), (None, None)], "t string, a string", T.eeg_only(F.col("t"), F.col("a"))) == [(True,), (False,), (False,), (False,)]


def test_chunks():
    text = "intro\n# A\nx\n### B\ny\n## C\n\n# D\n" + "z" * 30 + "\n" + "q" * 30
    got = D.chunks(text, 40)
    assert [(c["heading"], c["line_start"], c["line_end"]) for c in got] == [("Document", 1, 1), ("A", 2, 3), ("A > B", 4, 5), ("A > C", 6, 7), ("D", 8, 9), ("D", 10, 10)]
    assert D.chunks(None) == [] and D.chunks(" \n ") == []


def test_html_and_links():
    assert D.readable("<h1>A <b>b</b></h1><script>x</script><p>one</p><p>two &amp; three</p><h4>d</h4>") == "# A# b\n\none\n\ntwo & three\nd"
    assert "script" not in D.readable("<script>script</script><p>x</p>")
    assert D.readable("<h2 title='a>b'>T</h2><svg><p>no<svg/></svg>yes<br/>too<!-- <p> --><math>x</math> 1 < 2<style>p{}</style>") == "## T\n\nyes too 1 < 2"
    assert D.readable(None) == D.readable("<script>never closed <p>x") == ""


def test_entities_without_semicolon(spark):
    page = "<title>a&amp;&amp</title><p>&copy;&#65;&#x42; &ampx; &AMP x&copy</p>"
    rows = spark.createDataFrame([(page,)], "html string").select(D.html_to_markdown("html")).first()
    assert rows[0] == "a&&amp\n©AB &ampx; &AMP x&copy"
    pages = spark.createDataFrame([(1, page)], "document_id long, html string").select("document_id", D.html_to_markdown("html").alias("text"))
    assert [r["text"] for r in D.chunk_table(pages).collect()] == [rows[0]]
    assert D.readable(page) == "a&&\n©AB &x; & x©"


def test_links_and_literals(spark):
    rows = [
        ("doi:10.48550/arXiv.2301.1", None, None, "PMC12", "34", "https://arxiv.org/x"),
        ("x", None, None, None, None, "https://a.org/p q.pdf"),
        ("x", "bad doi", None, None, None, "https://u:p@a.org/"),
        ("x", None, None, None, None, "https://a.org/?k=1"),
        ("arXiv:2301.7", "https://doi.org/10.1/a(b);c", None, "12x", "3a", "HTTP://Doi.org:80/ü/a%20b+c*?"),
        ("arXiv:2301.7", " ", None, None, None, "http://B.org:80/ü/a%20b+c*?"),
        (None, None, None, None, None, None),
    ]
    names = "paper_id string, doi string, arxiv string, pmc string, pubmed string, url string"
    got = [r[0] for r in values(spark, rows, names, D.source_links(*map(F.col, ("paper_id", "doi", "arxiv", "pmc", "pubmed", "url"))))]
    assert got == [
        ["[DOI](https://doi.org/10.48550/arXiv.2301.1)", "[arXiv](https://arxiv.org/abs/2301.1)", "[PMC](https://pmc.ncbi.nlm.nih.gov/articles/PMC12/)", "[PubMed](https://pubmed.ncbi.nlm.nih.gov/34/)"],
        ["[Source: a.org](https://a.org/p%20q.pdf)"],
        [],
        [],
        ["[DOI](https://doi.org/10.1/a%28b%29%3Bc)", "[arXiv](https://arxiv.org/abs/2301.7)"],
        ["[arXiv](https://arxiv.org/abs/2301.7)", "[Source: b.org](http://B.org:80/%C3%BC/a%20b+c%2A)"],
        [],
    ]
    texts = [("<i>A</i>  *b* &lt;c_d&gt;",), (None,), ("a < b\u2003[x]`\\ &amp;amp; ",)]
    assert [r[0] for r in values(spark, texts, "t string", D.literal_markdown(F.col("t")))] == ["A \\*b\\* &lt;c\\_d&gt;", "", "a &lt; b \\[x\\]\\`\\\\ &amp;"]


@pytest.mark.parametrize("seed", range(3))
def test_terms_against_sqlite(seed):
    """Stems and words as SQLite's full-text index has them."""
    import sqlite3

    r = random.Random(seed)
    ends = "s es ed ing ly ness ful ational ization ative alize ical ement able ible ion ies y e ll er ism ity eed bl at iz".split()
    words = ["".join(r.choices("abcdefghilmnoprstuvwy", k=r.randrange(1, 8))) + r.choice(ends + [""]) for _ in range(3000)]
    words += "relational conditional rational hopping tanned falling hissing fizzed failing filing happy sky agreed feed plastered motoring conflated troubled sized caresses ponies ties caress cats Café naïve ÜBER x1 2020".split()
    db = sqlite3.connect(":memory:")
    db.execute("create virtual table t using fts5(x, tokenize='porter unicode61')")
    db.execute("create virtual table v using fts5vocab(t, 'instance')")
    db.executemany("insert into t(rowid, x) values (?, ?)", list(enumerate(words, 1)))
    theirs = {}
    for term, doc, _, _ in db.execute("select * from v"):
        theirs.setdefault(doc, []).append(term)
    for k, w in enumerate(words, 1):
        assert terms.stems(w) == theirs.get(k, []), w


def test_taxonomy():
    assert set(fixed.LEGACY_CATEGORIES.values()) <= set(fixed.VALID_CATEGORIES)


def test_abstracts_within_rows(spark, tmp_path):
    """Each text by itself, without a shuffle: null and empty ones, repeated ids, and places of repeated words."""
    from citeloom.plans import catalogue

    rows = [(1, "a b  a c a"), (2, None), (3, ""), (4, " x"), (1, "b a"), (5, "é  e é")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.queries()["abstracts"](spark, str(tmp_path))
    want = [(k, t and t.replace("  ", " ")) for k, t in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    index = spark.createDataFrame([(["b", "a", "b"],), (None,), ([],)], "w array<string>").select(D.inverted_index("w").alias("i"))
    assert [r.i for r in index.collect()] == [{"b": [0, 2], "a": [1]}, None, {}]
