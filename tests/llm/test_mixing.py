"""op10: the schedule's deviation, and whole results."""

import random
from fractions import Fraction

import pytest

from pyspark.sql import functions as F

from citeloom.llm import mixing as mx

from .helpers import documents


def ideal(blocks, weights, slot):
    """Each source's share after so many slots: all that have blocks left get their weights' shares of every moment."""
    left, got, time = [Fraction(n) for n in blocks], [Fraction(0)] * len(blocks), Fraction(slot)
    while time > 0 and any(left):
        live = [s for s, n in enumerate(left) if n]
        total = sum(weights[s] for s in live)
        step = min(time, *(left[s] * total / weights[s] for s in live))
        for s in live:
            got[s] += step * weights[s] / total
            left[s] -= step * weights[s] / total
        time -= step
    return got


@pytest.mark.parametrize("seed", range(30))
def test_deviation_is_less_than_a_block(seed):
    """At every slot, for sources of all sizes and weights, also after others have run out."""
    r = random.Random(seed)
    n = r.randrange(1, 8)
    blocks = [r.randrange(0, 40) for _ in range(n)]
    weights = [r.choice([1, 2, 3, 7, 40, 10**6, r.randrange(1, 100)]) for _ in range(n)]
    planned, counts = {}, [0] * n
    for s, (slots, releases, deadlines) in enumerate(mx.schedule(blocks, weights)):
        assert len(slots) == blocks[s] and slots == sorted(slots)
        for slot, release, deadline in zip(slots, releases, deadlines):
            assert release <= slot < deadline and slot not in planned
            planned[slot] = s
    assert sorted(planned) == list(range(sum(blocks)))
    for slot in range(sum(blocks)):
        counts[planned[slot]] += 1
        assert all(abs(c - share) < 1 for c, share in zip(counts, ideal(blocks, weights, slot + 1)))


def test_weights_are_exact():
    """One heavy source beside very many light ones gets its share, not a rounded one."""
    blocks, weights = [2000] + [1] * 2000, [1_000_000] + [1] * 2000
    slots = mx.schedule(blocks, weights)[0][0]
    assert len([s for s in slots if s < 1000]) >= 997 and slots[-1] < 2006


def test_larger_blocks_where_they_would_be_many(spark, monkeypatch):
    monkeypatch.setattr(mx, "MOST_BLOCKS", 10)
    docs = documents(spark, [(k, "x" * 100, "en", "ab"[k % 3 // 2]) for k in range(300)])
    found = mx.mix(docs, keep=["doc_id", "source"], size=F.octet_length("text"), weights={"a": 3, "b": 1}, block_size=50).collect()
    assert len(found) == 300 and len({x.slot for x in found}) <= 12
    assert all(x.release <= x.slot < x.deadline for x in found)


def test_rows_without_a_doc_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mx, "RANGE_ROWS", 20)
    docs = documents(spark, [(None, "x" * 10, "en", "a") for _ in range(400)] + [(k, "yy", "en", "a") for k in range(40)])
    found = mx.mix(docs, keep=["doc_id"], size=F.octet_length("text"), block_size=100).collect()
    assert len(found) == 440 and len({x.block_no for x in found}) == 41
    assert max(x.block_offset for x in found) < 100


@pytest.mark.parametrize("weight", [0, -1, 0.5])
def test_weights_below_one(spark, weight):
    with pytest.raises(ValueError):
        mx.mix(documents(spark, [(1, "x")]), keep=["doc_id"], size=F.octet_length("text"), weights={"s": weight})


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mx, "RANGE_ROWS", 20)
    r = random.Random(5)
    rows = [(k, "x" * r.randrange(0, 400), "en", r.choice(["hot"] * 4 + ["b", "c"])) for k in range(300)]
    docs = documents(spark, rows, extra=True)
    found = mx.mix(docs, keep=["doc_id", "source"], size=F.octet_length("text"), weights={"hot": 2, "b": 1, "c": 1}, block_size=500).collect()
    assert sorted(x.doc_id for x in found) == list(range(300))
    for name in ("hot", "b", "c"):
        mine = sorted((x for x in found if x.source == name), key=lambda x: (x.block_no, x.block_offset))
        at = 0
        seen = {}
        for x in mine:
            size = len(rows[x.doc_id][1])
            assert x.block_no == at // 500 or size == 0
            assert x.release <= x.slot < x.deadline
            seen.setdefault(x.block_no, x.slot)
            assert seen[x.block_no] == x.slot
            at += size
    by_slot = {}
    for x in found:
        by_slot.setdefault(x.slot, set()).add(x.source)
    assert all(len(v) == 1 for v in by_slot.values())
    again = mx.mix(docs, keep=["doc_id"], size=F.octet_length("text"), weights={"hot": 2, "b": 1, "c": 1}, block_size=500).collect()
    assert {x.doc_id: x.slot for x in again} == {x.doc_id: x.slot for x in found}


def test_cases(spark):
    rows = [(1, None, "en", None), (2, "", "en", None), (3, "x" * 5000, "en", "a"), (3, "x" * 5000, "en", "a"), (None, "yy", "en", "a")]
    docs = documents(spark, rows, extra=True)
    found = mx.mix(docs, keep=docs.columns, size=F.octet_length("text"), block_size=100)
    assert found.columns[: len(docs.columns)] == docs.columns and found.count() == 5
    assert mx.mix(documents(spark, []), keep=["doc_id"], size=F.octet_length("text")).collect() == []
