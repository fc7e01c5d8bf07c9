"""Top-k search by block bounds against scoring every match."""

import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators import search as S
from citeloom.operators import topk as K

QUERIES = ["graph", "graph brain", "graph OR mice", "graph NOT mice", "(graph OR mice) AND brain", "title : graph OR rare", "- title : graph", "graph rare", "the OR (rare NOT mice)", "none", "graph graph", "{title heading} : brain the"]
WORDS = "graph brain mice the of and x1 network".split()


@pytest.fixture(scope="module")
def index(spark):
    r = random.Random(8)
    text = lambda n: " ".join(r.choices(WORDS, [3, 2, 1, 30, 9, 9, 1, 1])[0] for _ in range(n))
    rows = [(10 * k, text(r.randrange(0, 3)), text(r.randrange(0, 2)), text(r.randrange(1, 60)) + (" rare" if k % 40 == 7 else "")) for k in range(1, 601)]
    chunks = spark.createDataFrame(rows, "chunk_id long, title string, heading string, text string")
    found = S.postings(chunks).cache()
    lengths = S.chunk_lengths(found, chunks).cache()
    return found, lengths, K.built(found, lengths, span=16)


@pytest.mark.parametrize("query", QUERIES)
def test_equal_hits(spark, index, query):
    postings, lengths, blocks = index
    node = S.Parser(query).parse()
    every = {r.chunk_id: r.score for r in S.bm25(postings, lengths, node).collect()}
    for k, first in ((5, 2), (40, 3)):
        got = K.best_hits(blocks, node, k, lengths, [F.asc("chunk_id")], first=first).select("chunk_id", "score").collect()
        want = sorted((round(s, 9), c) for c, s in every.items())[:k]
        assert [round(g.score, 9) for g in got] == [s for s, _ in want]
        assert all(abs(every[g.chunk_id] - g.score) < 1e-9 for g in got)
        assert {g.chunk_id for g in got if round(g.score, 9) < (want[-1][0] if want else 0)} == {c for s, c in want if s < want[-1][0]}


def test_filters_and_ties(spark, index):
    """Hits that a filter leaves out don't raise the floor, and equal scores are told apart by the order."""
    _, lengths, blocks = index
    kept = lengths.where("chunk_id % 70 = 0").withColumn("year", F.when(F.col("chunk_id") % 20 == 0, 2000))
    postings = index[0]
    node = S.Parser("the OR graph").parse()
    want = S.bm25(postings, lengths, node).join(kept, "chunk_id").orderBy(F.round("score", 9), F.desc_nulls_last("year"), "chunk_id").limit(7).collect()
    got = K.best_hits(blocks, node, 7, kept, [F.desc_nulls_last("year"), F.asc("chunk_id")], first=1).collect()
    assert [g.chunk_id for g in got] == [w.chunk_id for w in want]


def test_common_word_beside_a_rare_one(spark):
    """Of the postings of a word in all chunks less than a tenth is read."""
    rows = [(k, "", "", "the brain of " + ("zebra " if k in (1500, 1501, 2900) else "") + f"w{k}") for k in range(4000)]
    chunks = spark.createDataFrame(rows, "chunk_id long, title string, heading string, text string")
    postings = S.postings(chunks).cache()
    lengths = S.chunk_lengths(postings, chunks).cache()
    blocks = K.built(postings, lengths, span=64)
    node = S.Parser("the zebra").parse()
    read = K.read_share(blocks, node, 3, lengths)
    assert read["the"][1] == 4000 and 0 < read["the"][0] * 10 < read["the"][1] and read["zebra"] == (3, 3)
    assert sorted(r.chunk_id for r in K.best_hits(blocks, node, 3, lengths, [F.asc("chunk_id")]).collect()) == [1500, 1501, 2900]


def test_written_blocks(spark, index, tmp_path):
    postings, lengths, _ = index
    K.built(postings, lengths, f"{tmp_path}/b", span=32)
    again = K.opened(spark, f"{tmp_path}/b")
    assert again.blocks.agg(F.max(F.size("postings"))).first()[0] <= 32
    node = S.Parser("graph NOT brain").parse()
    assert K.best_hits(again, node, 3, lengths, [F.asc("chunk_id")]).count() == 3
    for query in ('"graph brain"', "gra*", "^graph", "NEAR(graph brain)"):
        with pytest.raises(ValueError):
            K.Query(again, S.Parser(query).parse())


def test_scores_to_the_last_digit(spark, index):
    """Hits that tie in one sum tie in the other: two words, whose order in the sum is no matter."""
    postings, lengths, blocks = index
    node = S.Parser("the graph").parse()
    every = {r.chunk_id: r.score for r in S.bm25(postings, lengths, node).collect()}
    query = K.Query(blocks, node)
    assert {r.chunk_id: r.score for r in query.scores(query.bounds()).collect()} == every and len(every) > 300
