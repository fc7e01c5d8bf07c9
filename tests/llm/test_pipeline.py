"""The pipeline's stages, each on its own input, and the whole against the stages' parts."""

import random

import numpy as np

import corpus_pipeline as cp
import __spark_entry__ as entry
from citeloom.llm import mixing, quality

from . import test_decontaminate, test_near_dedup, test_secrets
from .helpers import changed, documents, words


def tables(spark, place):
    r = random.Random(1)
    bench = [(k, words(30, 500 + k)) for k in range(5)]
    rows, labels = [], []
    for k in range(200):
        kind = k % 10
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in words(60, k).split())
        elif kind == 1 and k > 10:
            text = changed(rows[k - 9][1], k, 0.01)
        elif kind == 5:
            text = words(60, k) + " " + bench[k // 10 % 5][1] + " " + words(60, k + 1)
        elif kind == 6:
            text = words(80, k) + f" password = hunter{k}abcdefgh12 " + words(20, k)
        else:
            text = words(120, k)
        rows.append((k, text, "en", f"s{r.randrange(3)}"))
        labels.append((k, int(kind != 0), 0))
    documents(spark, rows, extra=True).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return rows


def test_stages_and_whole(spark, tmp_path):
    place = str(tmp_path)
    rows = tables(spark, place)
    docs = spark.read.parquet(f"{place}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, place)
        assert out.columns[: len(docs.columns)] == docs.columns and (len(out.columns) == len(docs.columns) or k == len(cp.STAGES) - 1)
        out.write.parquet(f"{place}/out{k}")
        docs = spark.read.parquet(f"{place}/out{k}")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["quality"]) == {k for k in range(200) if k % 10}
    near = {k for k in range(200) if k % 10 == 1 and k > 10}
    assert set(kept["near_duplicates"]) == set(kept["quality"]) - near
    assert set(kept["decontamination"]) == {k for k in kept["near_duplicates"] if k % 10 != 5}
    for k, text in kept["secrets"].items():
        assert ("hunter" not in text and "[SECRET]" in text) if k % 10 == 6 else text == rows[k][1]
    assert kept["mix"] == kept["secrets"]
    whole = cp.run(spark, place).collect()
    assert {r.doc_id: r.text for r in whole} == kept["mix"]
    assert len(whole) == len(kept["mix"])


def naive_score(machine, text, n_chars):
    """The machine's score with every pair of features on its own."""
    slots, values = quality.features(text, n_chars)
    raw = machine.bias + float((machine.linear[slots] * values).sum())
    vectors = machine.factors[slots].astype(np.float64) * values[:, None].astype(np.float64)
    raw += sum(float(vectors[i] @ vectors[j]) for i in range(len(slots)) for j in range(i))
    return 1 / (1 + np.exp(-raw))


def masked(text):
    spans = sorted((s, e) for s, _, e in test_secrets.brute(text))
    out, at = "", 0
    for s, e in spans:
        out += (text[at:s] + "[SECRET]") if s >= at and (s > at or not at) else ""
        at = max(at, e)
    return out + (text or "")[at:] if spans else text


def test_whole_against_brute_force(spark, tmp_path):
    """run() against every stage worked out plainly: all pairs of features, of documents, of words, and the schedule."""
    place = str(tmp_path)
    rows = tables(spark, place)
    docs, labels = spark.read.parquet(f"{place}/documents.parquet"), spark.read.parquet(f"{place}/labels.parquet")
    machine = quality.fitted(docs, labels)
    left = {i: t for i, t, *_ in rows if naive_score(machine, t, len(t)) >= quality.THRESHOLD}
    classes = test_near_dedup.brute(sorted(left.items()))
    left = {i: t for i, t in left.items() if classes[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{place}/benchmark.parquet").collect()]
    judged = {i: test_decontaminate.brute(t, bench) for i, t in left.items()}
    left = {i: masked(t) for i, t in left.items() if not (judged[i][1] and 20 * judged[i][1] >= judged[i][0])}
    found = cp.run(spark, place).collect()
    assert {r.doc_id: r.text for r in found} == left and len(found) == len(left)
    source = {i: s for i, _, _, s in rows}
    names = sorted({source[i] for i in left})
    sizes = [sum(len(left[i].encode()) for i in left if source[i] == s) for s in names]
    blocks = [n // mixing.BLOCK_BYTES + 1 for n in sizes]
    slots = {s: p[0] for s, p in zip(names, mixing.schedule(blocks, [int(n**0.5) for n in sizes]))}
    for s in names:
        mine = sorted((r for r in found if r.source == s), key=lambda r: (r.block_no, r.block_offset))
        at = 0
        for r in mine:
            assert at == r.block_no * mixing.BLOCK_BYTES + r.block_offset
            assert r["slot_" if "slot" in docs.columns else "slot"] == slots[s][r.block_no]
            at += len(left[r.doc_id].encode())


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_empty(spark, tmp_path):
    place = str(tmp_path)
    documents(spark, []).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    assert cp.run(spark, place).collect() == []


def test_nulls(spark, tmp_path):
    place = str(tmp_path)
    documents(spark, [(1, None, None, None), (None, None, None, None), (2, "", "en", None), (None, "a b c", None, "s")]).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    assert cp.run(spark, place).count() == 4
