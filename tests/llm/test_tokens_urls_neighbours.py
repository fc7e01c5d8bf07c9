"""op7 against greedy search, op3 against plain rules, op6 against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import common
from citeloom.llm import neighbours as nn
from citeloom.llm import token_counts as tc
from citeloom.llm import url_filter as uf

from .helpers import documents

DATA = "/root/testdata/sf0.01"


def greedy(word, begin, go_on):
    n, at = 0, 0
    while at < len(word):
        pieces = go_on if at else begin
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("seed", range(20))
def test_automaton_against_greedy(seed):
    r = random.Random(seed)
    piece = lambda: "".join(r.choices("abc", k=r.randrange(1, 6)))
    begin, go_on = {piece() for _ in range(8)}, {piece() for _ in range(8)}
    match = tc.LongestMatch(sorted(begin), sorted(go_on))
    for _ in range(400):
        word = "".join(r.choices("abc", k=r.randrange(1, 14)))
        assert match.count(word) == greedy(word, begin, go_on)


def test_counts_of_a_public_vocabulary(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    begin, go_on = tc.pieces_of(tc.VOCABULARY)
    names = ["[UNK]", *begin, *("##" + p for p in go_on)]
    vocabulary = {}
    for n in names:
        vocabulary.setdefault(n, len(vocabulary))
    model = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=100_000))
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in tc.op7_token_counts(spark, DATA).collect()}
    assert len(found) == len(rows)
    own = set(begin)
    for row in rows[:150]:
        words = [w for w in tc.WORD.findall(row.text) if not w.startswith("##")]
        want = sum(len(model.encode(w).tokens) for w in words)
        assert found[row.doc_id].n_tokens == want and found[row.doc_id].n_words == len(words)
    assert own and pre_tokenizers


def test_token_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "  "), (None, "the"), (4, "a" * 50_000), (4, "the the")], extra=True).drop("n_words")
    found = sorted((r.doc_id or 0, r.n_words, r.n_unknown) for r in tc.token_counts(docs, keep=["doc_id"]).collect())
    assert found == [(0, 1, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (4, 2, 0)]
    assert tc.token_counts(documents(spark, []), keep=["doc_id"]).collect() == []


def plain_rule(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [(h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, *best


URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.COM/en/7?x", "https://a.example.com/en/8#y", "http://example.net/de/8", "http://x.example.net/de/9", "http://www.org/es/",
    "http://com/en/", "http://notcom/en/", "http://b.com?/en/", "http://ÄB.com/en/", "x://y://z.org/es/1", "http://a.com/EN/", "http://example.com:80/en/7",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "<title>the end</title>") for k, u in enumerate(URLS)] + [(None, URLS[5], None)], "page_id long, url string, html string")
    for name in ("host", "verdict", "rule"):
        pages = pages.withColumn(name, F.lit("x"))
    assert {r.word: r.n for r in uf.title_words(pages).collect()} == {"the": len(URLS), "end": len(URLS)}
    rows = uf.segmented(pages.drop("host", "verdict", "rule"), keep=["page_id"])
    found = uf.judged(rows, uf.fitted(rows), keep=["page_id"]).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        host, path, rule, verdict = plain_rule(URLS[5 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    none = uf.segmented(pages.limit(0), keep=["page_id"])
    nothing = uf.fitted(none)
    assert uf.judged(none, nothing, keep=["page_id"]).collect() == []
    plain = uf.segmented(pages.where("url like '%no%scheme%'"), keep=["page_id"])
    assert {r.verdict for r in uf.judged(plain, nothing, keep=["page_id"]).collect()} == {"allow"}


def test_clashing_names(spark, tmp_path):
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(URLS)], "page_id long, url string, html string")
    for name in ("host", "verdict", "rule", "path", "decided", "word", "run", "at", "n", "host_words"):
        pages = pages.withColumn(name, F.lit("x"))
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = uf.op3_url_filter(spark, str(tmp_path))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert {(r.page_id, r.host, r.rule) for r in found.collect()} == {(k, plain_rule(u)[0], plain_rule(u)[2]) for k, u in enumerate(URLS)}


def test_against_counts_by_hand(spark):
    """Splits and scores of all pages, with words, pieces and tokens counted plainly."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    rows = uf.segmented(pages, keep=["page_id"])
    bayes = uf.fitted(rows)
    found = {r.page_id: r for r in uf.judged(rows, bayes, keep=["page_id"]).collect()}
    counts, seen, urls = Counter(), {"block": Counter(), "allow": Counter()}, Counter()
    plain = pages.collect()
    for p in plain:
        title = re.search(r"(?is)<title[^>]*>(.*?)</title>", p.html or "")
        counts.update(w for w in re.split(r"[^\W\d_]*?([^\W\d_]+)", title[1].lower())[1::2] if w) if title else None
    total = sum(counts.values())
    tokens = {}
    for p in plain:
        host, path, _, verdict = plain_rule(p.url)
        words = [w for label in host.split(".") for run in re.findall(r"[^\W\d_]+|\d+", label) for w in (["0"] if run[0].isdigit() else uf.split_run(run, counts, total))]
        assert found[p.page_id].host_words == words
        tokens[p.page_id] = [f"h:{w}" for w in words] + [f"p:{w.lower() if w.isalpha() else '0'}" for w in re.findall(r"[^\W\d_]+|\d+", path)]
        if verdict:
            urls[verdict] += 1
            seen[verdict].update(uf.slot_of(t) for t in tokens[p.page_id])
    sums = {v: sum(c.values()) + uf.SLOTS for v, c in seen.items()}
    for p in plain:
        odds = np.log(urls["block"] / urls["allow"])
        for t in map(uf.slot_of, tokens[p.page_id]):
            odds += np.log((seen["block"][t] + 1) / sums["block"]) - np.log((seen["allow"][t] + 1) / sums["allow"])
        assert abs(found[p.page_id].block_odds - odds) < 1e-6
        assert found[p.page_id].verdict == (plain_rule(p.url)[3] or ("block" if odds > 0 else "allow"))


def test_rare_words_of_many_titles(spark):
    """Hosts of words that titles hold once, beside more than 60,000 other words, are split as with all counts."""
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = sorted({"".join(w) for w in letters[np.random.default_rng(6).integers(0, 26, (62_000, 7))]})
    titles = [" ".join(words[k : k + 100]) + " the" for k in range(0, len(words), 100)]
    rows = [(k, f"http://{words[7 * k]}{words[9 * k + 1]}.{'comnetorg'[k % 3 * 3 :][:3]}/{'en de es xx'.split()[k % 4]}/{k}", f"<title>{t}</title>") for k, t in enumerate(titles)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = uf.segmented(pages, keep=["page_id"]).collect()
    assert len(found) == len(titles) and all(r.host_words[:2] == [words[7 * r.page_id], words[9 * r.page_id + 1]] for r in found)


def test_very_long_labels(spark):
    """A label of a million letters, a host of many dots, and a long label beside a plain one with the same words."""
    long, dots = "thegraph" * 125_000, "a." * 20_000 + "com"
    rows = [(1, f"http://{long}.org/es/1", "<title>The graph</title>"), (2, f"http://{dots}/en/", "<title>a</title>"), (3, "http://thegraph.net/de/1", None), (4, f"http://{long}.example/x", "")]
    found = {r.page_id: r for r in uf.segmented(spark.createDataFrame(rows, "page_id long, url string, html string"), keep=["page_id"]).collect()}
    assert found[1].host_words[:4] == ["the", "graph", "the", "graph"] and len(found[1].host_words) == 250_001 and found[1].rule == "org/es/"
    assert len(found[2].host_words) == 20_001 and found[2].rule == "com/en/" and found[3].host_words[:2] == ["the", "graph"]
    assert found[4].host_words[:2] == ["the", "graph"] and found[4].rule is None


def test_frequent_keys_that_a_lookup_lacks(spark):
    """Half of all rows have one key that the lookup lacks, a sixth has none: no partition of the join gets them all."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 6 == 5, None).when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 5000).alias("key"), "id")
    lookup = spark.range(4000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    joined = common.spread_join(rows.repartition(4), lookup, "key")
    got = joined.selectExpr("id", "key", "twice", "spark_partition_id() AS part").collect()
    assert len(got) == 60_000 and all(r.twice == (2 * r.key if r.key is not None and 0 <= r.key < 4000 else None) for r in got)
    parts = Counter(r.part for r in got)
    assert max(parts.values()) < 25_000


def test_segmentation():
    counts = {"the": 50, "end": 20, "then": 10, "d": 1}
    total = sum(counts.values())
    assert uf.split_run("theend", counts, total) == ["the", "end"] and uf.split_run("then", counts, total) == ["then"]

    def all_splits(word):
        yield [word]
        for k in range(1, len(word)):
            for rest in all_splits(word[k:]):
                yield [word[:k], *rest]

    cost = lambda parts: sum(uf.cost_of(p, counts, total) for p in parts)
    for word in ("thendend", "xthey", "dthen"):
        assert abs(cost(uf.split_run(word, counts, total)) - max(map(cost, all_splits(word)))) < 1e-9
        assert set(uf.split_run(word, counts, total)) <= set(uf.pieces_of(word))


def test_held_out_rules(spark, capsys):
    """Learned without one rule's urls, what the method says of those urls, by rule."""
    rows = uf.segmented(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), keep=["page_id"]).cache()
    right = {}
    for verdict, host, path in uf.RULES:
        own = F.coalesce(F.col("rule") == host + path, F.lit(False))
        bayes = uf.fitted(rows.where(~own))
        found = [r.block_odds > 0 for r in uf.judged(rows.where(own), bayes, keep=["page_id"]).collect()]
        if found:
            right[host + path] = (sum(x == (verdict == "block") for x in found), len(found))
    # and with a tenth of the decided urls held out instead of a rule
    fold = F.pmod(F.xxhash64("page_id"), F.lit(10)) == 0
    bayes = uf.fitted(rows.where(~fold))
    held = uf.judged(rows.where(fold & F.col("decided").isNotNull()), bayes, keep=["page_id"]).collect()
    share = np.mean([(r.block_odds > 0) == (r.verdict == "block") for r in held])
    with capsys.disabled():
        print(f"\nurls judged as their held-out rule says: {right}; held-out urls of known rules: {share:.2f} of {len(held)}")
    assert share > 0.8


def exact(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x * x[q]).sum(axis=1) / (norm * norm[q])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall_of(found, want):
    return np.mean([len({i for i, _ in found.get(q, [])} & {i for i, _ in v}) / max(1, len(v)) for q, v in want.items()])


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    found, want = by_query(nn.op6_nearest(spark, f"/root/testdata/{sf}")), exact(rows)
    assert set(found) == set(want)
    assert recall_of(found, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, hits in found.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0])) and len(hits) == 5
        for i, s in hits:
            a, b = vectors[q], vectors[i]
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


@pytest.mark.parametrize("rows", [4_000, 8_000, 20_000, nn.BLOCK_ROWS])
def test_recall_of_whole_blocks(rows):
    """Random vectors are the hardest: the k-th best is hardly nearer than all others."""
    data = np.random.default_rng(rows).normal(size=(rows, 64))
    unit = data / np.sqrt((data * data).sum(axis=1))[:, None]
    queries = range(0, rows, rows // 60)
    found = {}
    for q, i, _ in nn.Block(np.arange(rows), data).nearest({q: data[q] for q in queries}, 5):
        found.setdefault(q, set()).add(i)
    want = {q: [i for i in np.argsort(-(unit @ unit[q])).tolist() if i != q][:5] for q in queries}
    assert np.mean([len(found[q] & set(want[q])) / 5 for q in queries]) >= 0.95


def test_near_vectors_have_short_windows():
    """In clusters a query walks few entries of its lines: all rows of a large block are indexed, few are looked at."""
    r = np.random.default_rng(3)
    rows, middles = nn.BLOCK_ROWS, r.normal(size=(rows_of := 512, 64))
    data = middles[np.arange(rows) % rows_of] + 0.05 * r.normal(size=(rows, 64))
    block = nn.Block(np.arange(rows), data)
    unit = data / np.sqrt((data * data).sum(axis=1))[:, None]
    walked, hits = [], []
    for q in range(0, rows, rows // 20):
        found = [i for _, i, _ in block.nearest({q: data[q]}, 5)]
        want = [i for i in np.argsort(-(unit @ unit[q])).tolist() if i != q][:5]
        hits.append(len(set(found) & set(want)) / 5)
        half = nn.REACH * np.sqrt(2 - 2 * unit[q] @ unit[found[-1]])
        places = unit[q] @ block.unit
        walked.append(sum(int(np.searchsorted(p, x + half) - np.searchsorted(p, x - half)) for p, x in zip(block.places, places)) / nn.LINES)
    assert np.mean(hits) >= 0.95 and np.mean(walked) < 0.15 * rows


def test_neighbour_cases(spark):
    r = np.random.default_rng(2)
    rows = [(k, r.normal(size=8).tolist(), 0) for k in range(1, 40)] + [(50, r.normal(size=8).tolist(), 0)]
    rows += [(60 + k, rows[0][1], 1) for k in range(10)]  # ties
    rows += [(100, None, 0), (150, [0.0] * 8, 0), (200, [float("nan")] * 8, 0), (250, [None] * 8, 0), (None, rows[0][1], 0), (300, [1.0, 2.0], 0), (350, rows[0][1], 0), (350, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(1)).withColumn("score", F.lit(1))
    found = by_query(nn.nearest(df, df.where("vec_id % 50 = 0")))
    assert set(found) == {50, 350}
    assert [i for i, _ in found[350]] == [1, 60, 61, 62, 63]
    assert all(i not in (50, 100, 150, 200, 250, 300) for i, _ in found[50])
    long = [(k, r.normal(size=20_000).tolist(), 0) for k in (50, 51, 52)]
    wide = spark.createDataFrame(long, "vec_id long, embedding array<float>, label int")
    assert {i for i, _ in by_query(nn.nearest(wide, wide.where("vec_id = 50")))[50]} == {51, 52}
    two = spark.createDataFrame([(50, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (1, [0.0, 2.0], 0), (2, [3.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert by_query(nn.nearest(two, two.where("vec_id = 50")))[50][0] == (1, 1.0)
    small = by_query(nn.nearest(df, df.where("vec_id % 50 = 0"), pass_bytes=128))
    assert small == found
    assert nn.nearest(df.limit(0), df.where("vec_id = 50")).collect() == []
    assert nn.nearest(df, df.limit(0)).collect() == []


def test_wide_vectors_end_blocks(spark, monkeypatch):
    """Vectors of 1,536 components are held in blocks of bounded bytes, and neighbours come from all of them."""
    assert nn.BLOCK_BYTES < nn.BLOCK_ROWS * 1536 * 8
    r = np.random.default_rng(9)
    data = r.normal(size=(6000, 1536)).astype(np.float32)
    data[1:101] = data[0] + 0.01 * r.normal(size=(100, 1536))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<float>").coalesce(1)
    assert data.size * 8 > nn.BLOCK_BYTES
    found = nn.nearest(rows, rows.where("vec_id = 0")).orderBy("rank").collect()
    want = exact([(k, v) for k, v in enumerate(data[:200])])[0]
    assert [(f.vec_id, round(f.score, 12)) for f in found] == [(i, round(s, 12)) for i, s in want]
