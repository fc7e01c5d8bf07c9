"""op4 against brute force over all pairs."""

from itertools import combinations

import numpy as np
import pytest

from citeloom.llm import near_dedup as nd

from .helpers import changed, documents, words


def weighted_sets(rows):
    """doc_id -> {shingle: weight}, with words and frequencies counted plainly."""
    texts = {i: nd.split_words(t) for i, t in rows}
    hashes = nd.WordHashes()
    sets = {i: dict(zip(*[x.tolist() for x in nd.shingles(w, hashes)])) for i, w in texts.items() if w}
    plain = {i: {} for i in sets}
    for i, w in texts.items():
        n = min(nd.SHINGLE_WORDS, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            part = tuple(w[k : k + n])
            plain[i][part] = plain[i].get(part, 0) + 1
    for i in sets:
        assert sorted(sets[i].values()) == sorted(plain[i].values())
    often = np.zeros(nd.IDF_SLOTS, np.int64)
    for s in sets.values():
        for h in s:
            often[h % nd.IDF_SLOTS] += 1
    idf = nd.idf_weights(len(sets), often)
    return {i: {h: c * float(idf[h % nd.IDF_SLOTS]) for h, c in s.items()} for i, s in sets.items()}


def similarity(a, b):
    common = sum(min(w, b[h]) for h, w in a.items() if h in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute(rows):
    sets = weighted_sets(rows)
    top = {i: i for i, _ in rows}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sets, 2):
        if similarity(sets[a], sets[b]) >= nd.SIMILARITY:
            x, y = sorted((root(a), root(b)))
            top[y] = x
    return {i: root(i) for i, _ in rows}


def corpus():
    rows, line = [], " ".join(words(30, 999).split())
    n = 0
    for group in range(12):
        base = words(200, group)
        for copy in range(6):
            share = [0, 0, 0.005, 0.01, 0.02, 0.08][copy]
            rows.append((n, changed(base, n, share)))
            n += 1
    for k in range(60):
        rows.append((n, line + " " + words(20 + k, 5000 + k)))
        n += 1
    chain = words(300, 77).split()
    for k in range(8):  # neighbours are similar, the ends aren't
        rows.append((n, " ".join(chain[: 300 - 18 * k])))
        n += 1
    for k in range(40):
        rows.append((n, words(1 + k % 7, k)))
        n += 1
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    found = {r.doc_id: r.class_id for r in nd.near_duplicates(documents(spark, rows, extra=True)).collect()}
    assert found == brute(rows)


@pytest.mark.parametrize("pairs, run", [(nd.PAIRS_A_NODE, nd.RUN_PAIRS), (0, nd.RUN_PAIRS), (0, 8), (0.5, 8)])
def test_wide_group_of_copies(spark, monkeypatch, pairs, run):
    """Copies with such different numbers of changes that many aren't similar to the hub, and families within.

    With pairs verified at once or only by rounds of hubs, and with hubs in one run or in many.
    """
    monkeypatch.setattr(nd, "PAIRS_A_NODE", pairs)
    monkeypatch.setattr(nd, "RUN_PAIRS", run)
    base = words(300, 1, 10_000)
    rows = [(k, changed(base, k, (k % 20) / 250)) for k in range(150)]
    for k in range(150, 200):
        rows.append((k, changed(rows[k - 150][1], k, 0.01)))
    line = " ".join(words(60, 2, 10_000).split())
    for k in range(200, 240):
        rows.append((k, changed(base, k, 0.05) + " " + line))
    found = {r.doc_id: r.class_id for r in nd.near_duplicates(documents(spark, rows)).collect()}
    want = brute(rows)
    assert found == want and len(set(want.values())) > 5


def test_beyond_the_hub():
    """Two similar sets that are no lighter than a hub, and not both similar to it, share what each must beyond it."""
    r = np.random.default_rng(3)
    met = 0
    for _ in range(4000):
        base = r.choice(10**6, 40, replace=False)

        def near(share):
            own = base.copy()
            swap = r.random(40) < share
            own[swap] = r.integers(0, 10**6, swap.sum())
            own = np.unique(own[: r.integers(30, 41)]).astype(np.uint64)
            return own, 1.0 + (own % np.uint64(7)).astype(float) * r.choice([1, 1, 2], len(own))

        sets = sorted((near(s) for s in (0.1, 0.12, 0.02)), key=lambda s: s[1].sum())
        if r.random() < 0.5:
            keep = r.random(len(sets[1][0])) < 0.95
            sets[2] = (sets[1][0][keep], sets[1][1][keep])
        hub, a, b = sorted(sets, key=lambda s: s[1].sum())
        (ja, la, ka, ra), (jb, lb, kb, rb) = nd.beyond(hub, a, 0.8), nd.beyond(hub, b, 0.8)
        assert abs(ja - nd.weighted_jaccard(hub, a)) < 1e-9
        if nd.weighted_jaccard(a, b) >= 0.8 and min(ja, jb) < 0.8:
            met += 1
            _, i, j = np.intersect1d(ka, kb, return_indices=True)
            shared = np.minimum(ra[i], rb[j]).sum()
            assert shared >= max(la, lb) and (la > 0 or lb > 0)
    assert met > 50


def test_still_open():
    """Nodes 0 and 1 share enough beyond the hub; 2 is linked with it; 3 and 4 share too little; 5 shares nothing."""
    keys = [[1, 2, 3], [1, 2, 9], [3, 4], [4, 5], [5, 6], [7]]
    least = np.array([1.5, 2.0, -1.0, 5.0, 1.5, 0.5])
    flat = np.array([k for own in keys for k in own])
    kept = nd.still_open(least, np.array([len(k) for k in keys]), flat, np.ones(len(flat)))
    assert flat[kept].tolist() == [1, 2, 3, 1, 2, 3]
    assert nd.still_open(np.array([]), np.array([], int), np.array([], np.int64), np.array([])).tolist() == []


def test_recall_of_pairs(spark, capsys):
    """Of all pairs of weighted similarity 0.8 or more, those in one class."""
    rows = [(8 * k + j, changed(words(150 + 5 * k, k, 10_000), 100 * k + j, j / 100)) for k in range(60) for j in range(8)]
    sets = weighted_sets(rows)
    classes = {r.doc_id: r.class_id for r in nd.near_duplicates(documents(spark, rows)).collect()}
    near = [(a, b) for k in range(60) for a, b in combinations(range(8 * k, 8 * k + 8), 2) if similarity(sets[a], sets[b]) >= nd.SIMILARITY]
    caught = sum(classes[a] == classes[b] for a, b in near)
    with capsys.disabled():
        print(f"\n{caught} of {len(near)} pairs of similarity {nd.SIMILARITY} or more in one class")
    assert len(near) > 100 and caught >= 0.99 * len(near)


def test_large_group_of_near_copies(spark):
    base = words(400, 1)
    rows = [(k, changed(base, k, 0.004)) for k in range(300)] + [(1000 + k, words(50, k + 10)) for k in range(50)]
    found = nd.near_duplicates(documents(spark, rows)).collect()
    assert {r.class_id for r in found if r.doc_id < 300} == {0}
    assert all(r.class_id == r.doc_id for r in found if r.doc_id >= 1000)
    assert {r.class_size for r in found if r.doc_id < 300} == {300}


def test_cases(spark):
    text = words(50, 3)
    rows = [(7, text), (3, text.upper() + "!"), (None, text), (9, None), (10, ""), (11, " ... "), (12, "one two"), (13, "One, two."), (20, words(20_000, 4)), (20, words(20_000, 4))]
    found = nd.near_duplicates(documents(spark, rows, extra=True)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.class_id, r.class_size) for r in found if r.doc_id is not None) == [
        (False, 3, 3, 3), (False, 7, 3, 3), (False, 9, 9, 1), (False, 10, 10, 1), (False, 11, 11, 1), (False, 12, 12, 2), (False, 13, 12, 2), (False, 20, 20, 2), (False, 20, 20, 2),
    ]
    assert [r.class_id for r in found if r.doc_id is None] == [3]
    assert nd.near_duplicates(documents(spark, [])).collect() == []


def test_near_copies_without_a_doc_id(spark):
    """The shortest of a group, its hub, has no doc_id; another group has none at all; a third has it in two texts."""
    base, other, third = words(300, 1, 10_000), words(300, 2, 10_000), words(300, 3, 10_000)
    rows = [(None, " ".join(base.split()[:290])), (None, changed(base, 9, 0.004)), *((k, changed(base, k, 0.004)) for k in range(1, 8))]
    rows += [(None, other), (None, other + " end"), (None, other.upper() + " end")]
    rows += [(50, third), (None, third + " a"), (None, third + " b c"), (60, words(40, 4)), (None, words(40, 5)), (None, None)]
    named = [(100 + k, t) for k, (_, t) in enumerate(rows)]
    want = brute(named)
    sizes = [list(want.values()).count(want[i]) for i, _ in named]
    found = nd.near_duplicates(documents(spark, rows, extra=True)).collect()
    classes = {i: min((j for (j, _), (k, _) in zip(rows, named) if want[k] == want[i] and j is not None), default=None) for i, _ in named}
    expected = [(str(j), str(classes[i]), n) for (j, _), (i, _), n in zip(rows, named, sizes)]
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == sorted(expected)
    assert max(sizes) == 9


def test_keep_one(spark):
    text = words(50, 3)
    docs = documents(spark, [(7, text), (3, text), (9, None), (20, "a b c d e f g"), (20, "a b c d e f g"), (None, "x y")], extra=True)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 9), (False, 20), (True, 0)]


def test_keep_one_tells_rows_apart_by_text(spark):
    """Two texts under one doc_id are two documents, and so are texts without one; copies of either kind go."""
    a, b, c = (words(100, 30 + k, 10_000) for k in range(3))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (None, a + " tail"), (None, c), (None, c), (None, c + " end"), (5, None), (None, None), (6, b), (6, c + " more")]
    docs = documents(spark, rows, extra=True)
    kept = sorted((str(r.doc_id), r.text or "") for r in nd.keep_one(docs).collect())
    assert kept == sorted([("1", a), ("1", b), ("6", c + " more"), ("5", ""), ("None", "")])


@pytest.mark.parametrize("share", [0.05, 0.2, 0.5])
def test_samples_agree_as_often_as_sets_are_similar(share):
    r = np.random.default_rng(8)
    base = r.integers(0, 2**63, 400).astype(np.uint64)
    weights = r.uniform(0.5, 3, 400)
    other = base.copy()
    swap = int(share * 400)
    other[:swap] = r.integers(0, 2**63, swap).astype(np.uint64)
    agree = []
    for seed in range(12):
        s = nd.Sampler(seed)
        a = s.samples(base, weights, np.array([0]))
        b = s.samples(other, weights, np.array([0]))
        agree.append((a == b).mean())
    common = weights[swap:].sum()
    assert abs(np.mean(agree) - common / (2 * weights.sum() - common)) < 0.05


def test_large_sides_are_never_broadcast(spark):
    """Written tables are compressed: 10 MB of shingles beyond hubs were 201 MB in the driver."""
    rows = spark.createDataFrame([(1, 7), (2, 7), (1, 8)], "pair long, key long")
    shared = nd._shared_keys(rows, "pair")
    assert sorted(tuple(r) for r in shared.collect()) == [(7, 1, 2), (7, 2, 2)]
    placed = spark.createDataFrame([(7, b"a", 1.0, True), (7, b"b", 1.0, True), (8, b"a", 1.0, True)], "key long, node binary, weight double, alive boolean")
    left = placed.join(nd.by_shuffle(placed.groupBy("node").count()), "node")
    for df in (shared, left):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    parts = spark.createDataFrame([(b"a", b"a"), (b"b", b"b")], "node binary, component binary")
    found, pairs = nd._apart(placed, parts)
    assert pairs == 2 and {bytes(r.node) for r in found.collect()} == {b"a", b"b"}
