"""The title join against comparing all pairs."""

import random

from pyspark.sql import functions as F

from citeloom.operators import title_join as J


def plain(a, b):
    if not a or not b:
        return False
    short, long = sorted((a, b), key=len)
    return a == b or (len(short) > 20 and short in long)


def titles(n, seed):
    r = random.Random(seed)
    words = ["graph", "brain", "of", "the", "networks", "é", "fmri", "a", "connectivity", "in"]
    base = [" ".join(r.choice(words) for _ in range(r.randrange(1, 12))) for _ in range(n // 2)]
    out = list(base)
    while len(out) < n:
        t = r.choice(base)
        low = r.randrange(0, max(1, len(t) - 1))
        out.append(r.choice([t[low:], t[: low + 1], "the " + t + " revisited", t, "", t[low : low + 21]]))
    return [None, *out]


def test_all_pairs(spark):
    """2,000 titles, with cuts at any character, repeats and boilerplate that a third of them holds."""
    mine = titles(1000, 1)
    others = titles(1000, 2) + [t and ("proceedings of the annual meeting on " + t) for k, t in enumerate(mine) if k % 3 == 0]
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts], "key string").repartition(3)
    found = J.matching_titles(frame(mine), frame(others)).collect()
    got = {(r.left, r.right): (r.n_left, r.n_right) for r in found}
    assert len(got) == len(found)
    a, b = set(filter(None, mine)), set(filter(None, others))
    want = {(x, y): (mine.count(x), others.count(y)) for x in a for y in b if plain(x, y)}
    assert got == want and sum(x != y for x, y in got) > 100


def test_grams():
    assert J.WINDOW == 14


def test_short_and_long_titles(spark):
    frame = lambda *ts: spark.createDataFrame([(t,) for t in ts], "key string")
    long = "x" * 50_000 + "one title of 21 chars" + "y" * 100
    got = J.matching_titles(frame("one title of 21 chars", "title of 20 chars xx", "z"), frame(long, "z", "and title of 20 chars xx")).collect()
    assert sorted((r.left, len(r.right)) for r in got) == [("one title of 21 chars", len(long)), ("z", 1)]
    assert J.matching_titles(frame(), frame("a")).collect() == []


def test_no_pair_twice(spark):
    """Candidates meet by one gram: as many rows as pairs that share it, however many grams both have."""
    t = "a rather long title about brain graphs and their uses"
    frame = lambda *ts: spark.createDataFrame([(t,) for t in ts], "key string")
    assert frame(t).select(F.size(J.grams(F.col("key"))).alias("n")).first().n > 3
    assert len(J.matching_titles(frame(t), frame(f"on {t}", f"{t} ii")).collect()) == 2


def test_grams_go_without_texts(spark, monkeypatch):
    """Tables of grams hold numbers of titles: a long title with each of its grams would be a square of its length."""
    seen, real = [], J.cut_lineage
    monkeypatch.setattr(J, "cut_lineage", lambda df: seen.append(dict(df.dtypes)) or real(df))
    frame = lambda *ts: spark.createDataFrame([(t,) for t in ts], "key string")
    t = "a rather long title about brain graphs and their uses"
    assert J.matching_titles(frame(t, "quite another title of this table"), frame(f"on {t}", t[5:40])).count() == 2
    assert [k for k in seen if "gram" in k] and not [k for k in seen if "gram" in k and "string" in k.values()]
