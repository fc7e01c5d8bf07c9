"""Phrase collocations against plain counts, with runs and ranges so small that every bound is crossed."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from citeloom.llm import phrases

from .helpers import documents


def plain(rows, least, held_share=50):
    """{(lang, phrase): (a, l, r, n, score)} by counting."""
    counts = {}
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        seen = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                seen.update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = {}
    for lang, seen in counts.items():
        n = sum(v for k, v in seen.items() if len(k) == 1)
        kept = {k: v for k, v in seen.items() if len(k) > 1 and v >= least}
        held = {part for k, v in kept.items() if len(k) == 3 for part in (k[:2], k[1:]) if 100 * v >= held_share * seen[part]}
        for k, a in kept.items():
            if k not in held:
                score, _, l, r = min((10**6 * a * a // (seen[k[:j]] * seen[k[j:]]), j, seen[k[:j]], seen[k[j:]]) for j in range(1, len(k)))
                out[lang, " ".join(k)] = (a, l, r, n, score)
    return out


def found(df):
    rows = df.collect()
    out = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], int(r["score"])) for r in rows}
    assert len(out) == len(rows)
    return out


def prose(seed, words):
    r = random.Random(seed)
    names = ["a", "b", "B", "c\x00", "é", "dd", "\x01", "ß-x", "a\x0b", "e"]
    return "".join(r.choices(names, [9, 5, 2, 1, 1, 3, 1, 1, 1, 2])[0] + r.choices([" ", "  ", "\t", ". ", ",", "\n"], [12, 2, 1, 1, 1, 1])[0] for _ in range(words))


@pytest.mark.parametrize("run_words, range_nodes", [(40, 9), (300, 60), (5000, 1 << 20)])
def test_counts(spark, monkeypatch, run_words, range_nodes):
    monkeypatch.setattr(phrases, "MARK_NODES", 3)
    monkeypatch.setattr(phrases, "BLOCK_NODES", 11)
    rows = [(k, prose(k, 120), [None, "und", "en", "d\ne"][k % 4]) for k in range(12)] + [(50, None, "en"), (51, "", "fr"), (52, " .\t", "fr")]
    df = phrases.collocations(documents(spark, rows, extra=True).repartition(3), least=3, range_nodes=range_nodes, run_words=run_words)
    assert found(df) == plain([(lang, text) for _, text, lang in rows], 3)


def test_hot_word_spans_ranges(spark, monkeypatch):
    """A word that begins a third of all phrases, and the ranges that begin inside it."""
    monkeypatch.setattr(phrases, "MARK_NODES", 2)
    monkeypatch.setattr(phrases, "BLOCK_NODES", 7)
    r = random.Random(1)
    rows = [(k, " ".join("the w%d x%d" % (r.randrange(9), r.randrange(4)) for _ in range(60)), "en") for k in range(9)]
    blocks = phrases.checkpointed(phrases.tries(documents(spark, rows).repartition(3), run_words=100))
    bounds = phrases.bounds_of(blocks, 10)
    assert sum(path[0] == b"the" for _, path in bounds) > 3
    df = phrases.collocations(documents(spark, rows).repartition(3), least=2, range_nodes=10, run_words=100)
    assert found(df) == plain([(lang, text) for _, text, lang in rows], 2)


def test_long_texts(spark, monkeypatch):
    """Stretches and runs end inside pieces, and one word is longer than a stretch."""
    monkeypatch.setattr(phrases, "STRETCH", 64)
    r = random.Random(3)
    text = " ".join(r.choices("abcdef", k=2000)) + " " + "z" * 500 + " " + " ".join(r.choices("abc", k=500)) + "y" * 200
    rows = [(1, text, "en"), (2, "a b " + text, "en"), (3, "q" * 300, "en")]
    df = phrases.collocations(documents(spark, rows), least=4, run_words=150, range_nodes=50)
    assert found(df) == plain([(lang, text) for _, text, lang in rows], 4)


def test_trie_round_trip():
    shard = phrases.Shard()
    shard.add("en", b"a b c\na b d a", True)
    ((_, nodes),) = shard.runs()
    paths = [nodes.path(k) for k in range(len(nodes.keys))]
    assert paths == sorted(paths, key=lambda p: tuple(w + b"\n" for w in p))
    assert dict(zip(paths, nodes.counts.tolist(), strict=True))[(b"a", b"b")] == 2
    for low in range(len(paths)):
        part = phrases.unpacked(nodes.part(low, low + 4).packed())
        own = [k for k in range(len(part.keys)) if not part.carried[k]]
        assert [part.path(k) for k in own] == paths[low : low + 4]
        assert [part.counts[k] for k in own] == nodes.counts[low : low + 4].tolist()
        assert [nodes.place(p) for p in paths] == list(range(len(paths)))


def test_exact_scores(spark, monkeypatch):
    """Products beyond 64 bits."""
    big = 3_000_000_001
    said = spark.createDataFrame(
        [("en", None, 0, 10 * big, None, None), ("en", "a", 1, 2 * big, None, None), ("en", "b", 1, 3 * big, None, None), ("en", "a b", 2, big, 2 * big, None)],
        "lang string, phrase string, words int, a long, left1 long, left2 long",
    )
    monkeypatch.setattr(phrases, "merged_phrases", lambda *a, **k: said)
    row = phrases.collocations(documents(spark, [(1, "x")])).first()
    assert (row["score"], row["l"], row["r"], row["n"]) == (10**6 // 6, 2 * big, 3 * big, 10 * big)


def test_order_and_top(spark):
    rows = [(k, "b a. d c. c d. z z z.", "en") for k in range(5)]
    top = phrases.best(phrases.collocations(documents(spark, rows), least=5), 3).orderBy("rank").collect()
    # 'z z' occurs more often than it is held; equal scores and counts go by the phrase
    assert [r["phrase"] for r in top] == sorted(["b a", "c d", "d c"], key=lambda p: (-plain([("en", t) for _, t, _ in rows], 5)["en", p][4], p))
    assert phrases.best(phrases.collocations(documents(spark, []))).count() == 0


def test_trie_memory():
    """A run's trie takes less than 100 bytes a word at its peak, with nearly as many different phrases as words."""
    size, numbers = 1 << 18, phrases.Numbers()
    ids = np.array([numbers[b"w%d" % k] for k in np.power(20_000, np.random.default_rng(5).random(size)).astype(int)], np.int32)
    tracemalloc.start()
    found = phrases.trie(numbers, ids, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.counts[found.depths() == 1].sum() == size and len(found.keys) > size and peak < 100 * size
