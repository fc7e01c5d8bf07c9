"""op5 against Python's regular expressions, and the ledger."""

import random
import re

from pyspark.sql import functions as F

from citeloom.llm import secrets as sc

from .helpers import documents

PATTERNS = [
    (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    (re.compile(r"[0-9a-f]+"), 0, 16),
]


def brute(text):
    spans = []
    for rank, (pattern, group, least) in enumerate(PATTERNS):
        spans += [(m.start(), rank, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(spans)


def texts():
    r = random.Random(3)
    pieces = ["password", "Secret", "TOKEN", "api_key", "apikey", "=", ": ", '"', " ", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "x", "\n", "token=short", "token='", "secret:abcdefghijklmnop", "ü "]
    return ["".join(r.choices(pieces, k=r.randrange(0, 25))) for _ in range(400)]


def scanned(spark, rows, extra=False):
    docs = documents(spark, rows, extra=extra)
    return sc.findings_of(docs, sc.scanned(docs), keep=["doc_id"])


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    for r in scanned(spark, rows).collect():
        assert [(s.start, s["rank"], s.end) for s in r.spans if s["rank"] < 3] == brute(rows[r.doc_id][1])


def test_more_rules(spark):
    text = "-----BEGIN RSA PRIVATE KEY----- and ghp_" + "A1" * 20
    spans = scanned(spark, [(1, text)]).select(sc.as_text(F.col("spans")).alias("s")).first().s
    assert spans == "pem:0:31,forge:36:80"


def test_cases(spark):
    secret = "token=abcdefghijklmnop"
    rows = [(1, None), (2, ""), (3, secret), (4, secret), (3, secret), (None, secret), (None, "x"), (9, "y" * 100_000 + secret)]
    found = scanned(spark, rows, extra=True).collect()
    assert sorted((r.doc_id or 0, len(r.spans)) for r in found) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1), (9, 1)]
    assert scanned(spark, []).collect() == []


def test_ledger_scans_each_blob_once(spark):
    first = documents(spark, [(1, "secret=aaaaaaaaaaaaaaaa"), (2, "clean")])
    ledger = sc.scan_ledger(first).cache()
    assert ledger.count() == 2
    later = documents(spark, [(3, "secret=aaaaaaaaaaaaaaaa"), (4, "token: bbbbbbbbbbbbbbbb"), (5, "clean")])
    assert [r.text for r in sc.unseen_texts(later, ledger).collect()] == ["token: bbbbbbbbbbbbbbbb"]
    assert sc.unseen_texts(later, ledger, rule_version="other").count() == 3
    whole = ledger.unionByName(sc.scan_ledger(later, ledger))
    found = {r.doc_id: len(r.spans) for r in sc.findings_of(later, whole, keep=["doc_id"]).collect()}
    assert found == {3: 2, 4: 2, 5: 0}  # an assignment and a run of hexadecimal digits each


def test_kept_ledger(spark, tmp_path):
    """A second scan of the same versions reads the ledger and scans nothing; clean blobs are in it; new rules scan all."""
    folder = str(tmp_path / "ledger")
    rows = [(1, "secret=aaaaaaaaaaaaaaaa"), (2, "clean"), (3, "clean"), (4, None), (5, "token: bbbbbbbbbbbbbbbb")]
    docs = documents(spark, rows, extra=True)
    first = {(r.blob, r.rule_version, len(r.spans)) for r in sc.scanned(docs, folder).collect()}
    assert len(first) == 4 and sorted(n for _, _, n in first) == [0, 0, 2, 2]
    assert sc.scan_ledger(docs, spark.read.parquet(folder)).collect() == []
    again = sc.scanned(docs, folder)
    assert again.count() == 4 and {(r.blob, r.rule_version, len(r.spans)) for r in again.collect()} == first
    more = sc.scanned(documents(spark, [*rows, (9, "new token=cccccccccccccccc")]), folder)
    assert more.count() == 5
    assert sc.scanned(docs, folder, rule_version="other").count() == 9
    found = {r.doc_id: len(r.spans) for r in sc.findings_of(docs, spark.read.parquet(folder), keep=["doc_id"]).collect()}
    assert found == {1: 2, 2: 0, 3: 0, 4: 0, 5: 2}


def test_very_many_matches_and_copies(spark, monkeypatch):
    """More matches in a text than are gathered together; and a blob of most rows, joined without a broadcast of all."""
    monkeypatch.setattr(sc, "SKIPPED_ROWS", 0)
    long = " ".join(f"x token=abcdefghijkl{k % 10} é" for k in range(sc.PIECE * 3 + 5))
    common = "0123456789abcdef"
    rows = [(1, long), *((k, common) for k in range(2, 400)), *((k, f"secret={k:016}") for k in range(400, 420))]
    found = {r.doc_id: [(s.start, s["rank"], s.end) for s in r.spans] for r in scanned(spark, rows).collect()}
    assert found == {i: brute(text) for i, text in rows}


def test_redaction(spark, monkeypatch):
    rows = [(1, "a secret=abcdefghijklmnop b 0123456789abcdef"), (2, "clean"), (3, None), (4, "token=0123456789abcdef01"), (4, "token=0123456789abcdef01")]
    docs = documents(spark, rows, extra=True)
    want = {1: "a [SECRET] b [SECRET]", 2: "clean", 3: None, 4: "[SECRET]"}
    for most in (500_000, 0):
        monkeypatch.setattr(sc, "SKIPPED_ROWS", most)
        found = sc.redact(docs)
        assert found.columns == docs.columns and found.count() == 5
        assert {r.doc_id: r.text for r in found.collect()} == want
