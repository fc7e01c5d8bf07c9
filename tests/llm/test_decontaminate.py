"""op1 against a plain search."""

import hashlib
import random
import re

from citeloom.llm import decontaminate as dc

from .helpers import documents


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w = plain_words(text)
    hit, found = [False] * len(w), set()
    for item, other in items:
        v = plain_words(other)
        n = min(13, len(v))
        for k in range(len(v) - n + 1 if n else 0):
            for at in range(len(w) - n + 1):
                if w[at : at + n] == v[k : k + n]:
                    hit[at : at + n] = [True] * n
                    found.add(item)
    return len(w), sum(hit), found


def case(seed):
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice(["a", "b", "C", "é", "x1", "..."]) + r.choice(["", ",", "\n"]) for _ in range(n))
    items = [(k, text(r.randrange(1, 40))) for k in range(12)] + [(50, ""), (51, None), (52, "b"), (53, "É b")]
    docs = []
    for k in range(60):
        body = text(r.randrange(0, 120))
        if k % 2:
            body += " " + (r.choice(items)[1] or "") + " " + text(20)
        docs.append((k, body))
    return docs, items


def test_against_brute_force(spark):
    docs, items = case(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 200):
        found = dc.contamination(documents(spark, docs, extra=True).drop("n_words"), bench, keep=["doc_id"], block_bytes=block_bytes).collect()
        assert len(found) == len(docs)
        for r in found:
            n, hit, which = brute(dict(docs)[r.doc_id], items)
            assert (r.n_words, r.n_hit, sorted(r.hit_items)) == (n, hit, sorted(map(str, which)))
            assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_cases(spark):
    bench = spark.createDataFrame([(1, "one two three"), (None, "four"), (3, None)], "item_id long, text string")
    docs = documents(spark, [(1, None), (2, ""), (3, "One TWO three"), (3, "One TWO three"), (None, "four five")], extra=True)
    found = dc.contamination(docs.drop("n_words"), bench, keep=["doc_id"]).collect()
    assert sorted(((r.doc_id or 0), r.n_words, r.n_hit, tuple(r.hit_items)) for r in found) == [(0, 2, 1, ()), (1, 0, 0, ()), (2, 0, 0, ()), (3, 3, 3, ("1",)), (3, 3, 3, ("1",))]
    assert dc.contamination(documents(spark, []), bench, keep=["doc_id"]).collect() == []
    assert [r.n_hit for r in dc.contamination(docs, bench.limit(0), keep=["doc_id"]).collect()] == [0] * 5


def test_query_digest(spark, tmp_path):
    documents(spark, [(1, "x one two y"), (2, "z")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, "one two"), (9, "two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in dc.op1_decontaminate(spark, str(tmp_path)).collect()}
    assert found[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and found[1].n_items == 2
    assert found[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_searcher_memory():
    """Two megabytes of benchmark take some fifteen times as much, and equal windows keep all their owners."""
    import tracemalloc

    r = random.Random(3)
    names = [f"w{k}" for k in range(30_000)]
    items = [(str(k), " ".join(r.choices(names, k=3000))) for k in range(110)]
    tracemalloc.start()
    searcher = dc.Searcher(items, 13)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    size = sum(len(t) for _, t in items)
    assert size > 1_900_000 and held < 20 * size and peak < 80 * size
    same = dc.Searcher([(str(k), "a b c d e f g h i j k l m n") for k in range(500)] + [("x", "c d")], 13)
    spans, owners = same.search(b"z a b c d e f g h i j k l m n z".split())
    assert spans == [(1, 15)] and owners == {*map(str, range(500)), "x"}


def test_very_long_text(spark):
    items = spark.createDataFrame([("a", " ".join(f"b{k}" for k in range(20)))], "item_id string, text string")
    text = "w " * 2_000_000 + " ".join(f"b{k}" for k in range(5, 18)) + " w" * 10
    (row,) = dc.contamination(documents(spark, [(1, text)]), items, keep=["doc_id"]).collect()
    assert (row.n_words, row.n_hit, row.hit_items) == (2_000_023, 13, ["a"])
