"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of its shingles of five words (one shingle of all its words if it has fewer). The weight of a
shingle is its count times the square root of its smoothed inverse document frequency. Document frequencies are counted
over all documents in hashed features (`IDF_SLOTS`), so the table has one size for any corpus.

1. Improved consistent weighted sampling draws 64 samples a document; two documents agree in a sample with the probability
   of their weighted Jaccard similarity. Texts of equal words are one node from here on, with one signature.
2. Sixteen bands of four samples are the bucket keys. A pair of similarity 0.8 shares a bucket with probability 0.9998.
3. Every node of a bucket is held against its lightest node, the hub. Pairs are verified by the weighted Jaccard similarity
   of the whole texts, as a stream sorted by the hub, so a group of any size needs the memory of two documents.
4. The classes are the connected components of the verified pairs.
5. Two nodes of a bucket that aren't both linked with the hub can still be similar. What one of them shares with the hub is
   less than what the two must share, because the hub is no heavier; so they share enough beyond the hub. Shingles beyond a
   hub that no other of its nodes has can't be shared, and a node without enough of the others is done. In copies of a
   text with changes of their own that leaves very few; a hub with one run tells that within its task. Further hubs of the
   keys that are left join what the first left apart, with no shingles sent. Pairs of two components are then verified, or
   where they are many for each node of the corpus, the keys are the buckets of another round. No pair is lost, and
   groups of copies that aren't similar enough are told apart without holding all against all.

Shingles of under 1 % of all documents weigh alike (`RARE_SHARE`), so that an edit isn't worth more than the text around it
and near copies keep their similarity; more common ones, such as those of licences and page furniture, weigh the less the more
documents have them. By chance a hashed feature holds about 0.1 % of the documents (mean shingles by slots), whatever their
number, so hashing doesn't show in the weights, and they are alike at every size of a corpus.

Defined cases: null, empty and wordless texts are alone in a class of their own; a class is named by its smallest doc_id
that isn't null, or null if all are; repeated rows of a document are repeated in the result and in one class; very long
texts count whole; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from citeloom.operators.graph import BROADCAST_ROWS, by_shuffle, connected_components, drop_kept

from .common import HOT_KEYS, arrow_map, checkpointed, shuffle_width, slices, split_words, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SAMPLES = 64
BAND_ROWS = 4
BANDS = SAMPLES // BAND_ROWS
IDF_SLOTS = 1 << 18
#: Shingles of a smaller share of all documents are alike rare.
RARE_SHARE = 0.01
#: Counts of features leave a task in so many parts.
IDF_PARTS = 64
#: Pairs with one hub that a task verifies as one run, and the shingles beyond the hub that it holds of them, at most.
RUN_PAIRS = 512
RUN_KEYS = 1 << 21
#: Nodes whose rows get their class by a broadcast, at most: those with at least this part of all rows.
HOT_NODES = 1024
#: Further hubs of a key that join components before the next round.
SWEEP_HUBS = 4
#: Rows of the last round's join for each node of the corpus, at most; before that, further rounds have fewer.
PAIRS_A_NODE = 5
#: Rounds, at most: whatever is left in the last is verified pair by pair.
MOST_ROUNDS = 8
_POOL = 1 << 12
_KEPT_WORDS = 1 << 18
_ODD = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """64-bit hashes of words, kept for the most recent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, with counts."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(SHINGLE_WORDS, n)
    out = each[: n - width + 1].copy()
    for k in range(1, width):
        out *= np.uint64(_ODD)
        out += each[k : n - width + 1 + k]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return np.unique(out, return_counts=True)


def digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents with words, and how many hold a shingle of each hashed feature. Parts are summed before the driver sees one."""
    source = docs.select(docs[text].alias("text"))

    def count(batches):
        hashes, total, n = WordHashes(), np.zeros(IDF_SLOTS, np.int64), 0
        for whole in batches:
            for batch in slices(whole):
                found = [shingles(split_words(t), hashes)[0] for t in batch.column(0).to_pylist()]
                found = [f for f in found if len(f)]
                n += len(found)
                if found:
                    total += np.bincount((np.concatenate(found) % np.uint64(IDF_SLOTS)).astype(np.int64), minlength=IDF_SLOTS)
        if n:
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(total, IDF_PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(IDF_PARTS), pa.int32()), pa.array([n] * IDF_PARTS, pa.int64()), pa.array(parts, pa.binary())], names=["part", "n", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        docs_: dict[int, int] = {}
        for batch in batches:
            for part, n, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(counts), np.int64)
                docs_[part] = docs_.get(part, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([docs_[p] for p in sums], pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "n", "counts"])

    schema = "part int, n long, counts binary"
    rows = source.mapInArrow(count, schema).repartition(min(IDF_PARTS, shuffle_width(docs.sparkSession)), "part").mapInArrow(add, schema).collect()
    total = np.zeros((IDF_PARTS, IDF_SLOTS // IDF_PARTS), np.int64)
    for r in rows:
        total[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return max([0, *(r["n"] for r in rows)]), total.ravel()


def idf_weights(n: int, frequencies: np.ndarray, rare_share: float = RARE_SHARE) -> np.ndarray:
    """Square root of ln((1+N)/(1+df)) + 1, per feature, with df of a share of all documents at least."""
    often = np.maximum(np.minimum(frequencies, n), rare_share * n)
    return np.sqrt(np.maximum(0.0, np.log((1.0 + n) / (1.0 + often))) + 1).astype(np.float32)


def weighted(words: list[bytes], hashes: WordHashes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = shingles(words, hashes)
    return found, counts * idf[(found % np.uint64(IDF_SLOTS)).astype(np.int64)].astype(np.float64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    common = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


class Sampler:
    """Improved consistent weighted sampling: r, c ~ Gamma(2, 1) and beta ~ U(0, 1) for each shingle and sample.

    The three come from pools, each indexed by other bits of the shingle's hash, so equal shingles always get equal values.
    """

    def __init__(self, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        shape = (_POOL, SAMPLES)
        self.r = random.gamma(2, 1, shape).astype(np.float32)
        self.r = np.maximum(self.r, np.float32(1e-3))
        self.inverse = (1 / self.r).astype(np.float32)
        self.log_c = np.log(np.maximum(random.gamma(2, 1, shape), 1e-8)).astype(np.float32)
        self.beta = random.random(shape, np.float32)
        self.odd = random.integers(1, 1 << 31, SAMPLES, dtype=np.uint32) | np.uint32(1)

    def samples(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, block: int = 2048) -> np.ndarray:
        """One row of 64-bit samples a document: rank of the draw above, fingerprint of (shingle, level) below."""
        n = len(hashes)
        out = np.full((len(starts), SAMPLES), np.uint64(2**64 - 1))
        log_s = np.log(weights).astype(np.float32)
        mask = np.uint64(_POOL - 1)
        slot = [((hashes >> np.uint64(k)) & mask).astype(np.int64) for k in (4, 20, 36)]
        prints = (hashes >> np.uint64(17)).astype(np.uint32)
        for low in range(0, n, block):
            high = min(n, low + block)
            r, beta, log_c = self.r[slot[0][low:high]], self.beta[slot[1][low:high]], self.log_c[slot[2][low:high]]
            level = self.inverse[slot[0][low:high]]
            level *= log_s[low:high, None]
            level += beta
            np.floor(level, out=level)
            beta -= level
            beta -= 1
            beta *= r
            beta += log_c  # log c - r (t + 1 - beta)
            beta += 64
            np.clip(beta, 0, 127.99, out=beta)
            beta *= 2.0**25
            key = beta.astype(np.uint64)
            key <<= np.uint64(32)
            mark = level.astype(np.int32).view(np.uint32)
            mark *= np.uint32(0x85EBCA6B)
            mark ^= prints[low:high, None]
            mark *= self.odd
            key |= mark
            first = int(np.searchsorted(starts, low, "right")) - 1
            last = int(np.searchsorted(starts, high, "left"))
            cuts = np.maximum(starts[first:last] - low, 0)
            np.minimum(out[first:last], np.minimum.reduceat(key, cuts, axis=0), out=out[first:last])
        return (out & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def signatures(docs: DataFrame, idf: np.ndarray, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, raw, node, bands, weight): raw is a digest of the text; node is null for texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def setup():
        hashes, sampler, weights = WordHashes(), Sampler(), shared.value

        def run(texts):
            nodes, parts, at = [], [], []
            for i, value in enumerate(texts.to_pylist()):
                words = split_words(value)
                nodes.append(digest(words) if words else None)
                if words:
                    parts.append(weighted(words, hashes, weights))
                    at.append(i)
            bands, total = [None] * len(nodes), [None] * len(nodes)
            if parts:
                starts = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])[:-1]])
                found = sampler.samples(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), starts)
                keys = np.zeros((len(parts), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
                for k in range(BAND_ROWS):
                    keys = (keys ^ found[:, k::BAND_ROWS]) * np.uint64(_ODD)
                    keys ^= keys >> np.uint64(29)
                for j, i in enumerate(at):
                    bands[i], total[i] = keys[j].view(np.int64), float(parts[j][1].sum())
            return [pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(total, pa.float64())]

        return run

    fields = [T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("weight", T.DoubleType())]
    named = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), _raw(docs[text]).alias("raw"))
    return arrow_map(named, ["text"], ["doc_id", "raw"], fields, setup)


def _raw(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def nodes_of(texts: pa.Array) -> pa.Array:
    """The nodes of texts; null for texts without words."""
    return pa.array([digest(words) if (words := split_words(t)) else None for t in texts.to_pylist()], pa.binary())


def texts_of(nodes: DataFrame, docs: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """(node, text) of (node, doc_id), one row a node. Up to BROADCAST_ROWS nodes are broadcast, and no other text moves.

    A node's text is found by the node's doc_id, and by its digest: other texts can have the same doc_id, or none.
    """
    ids = checkpointed(nodes.select(F.col("node").alias("__node"), F.col("doc_id").alias("__id")))
    small = F.broadcast if ids.count() <= BROADCAST_ROWS else by_shuffle
    source = docs.select(docs[doc_id].alias("__id"), docs[text].alias("text"))
    found = source.join(small(ids.where("__id is not null").select("__id").distinct()), "__id", "left_semi")
    nameless = ids.where("__id is null")
    if not nameless.isEmpty():
        found = found.unionByName(source.where("__id is null"))
    digests = arrow_map(found, ["text"], ["text"], [T.StructField("node", T.BinaryType())], lambda: lambda texts: [nodes_of(texts)])
    wanted = small(ids.select(F.col("__node").alias("node")))
    return digests.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))


def beyond(hub: tuple[np.ndarray, np.ndarray], own: tuple[np.ndarray, np.ndarray], similarity: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The similarity with the hub; what a node no lighter than the hub that is similar to `own` must share with it beyond
    the hub at least; and the shingles beyond the hub with their weights there."""
    at = np.minimum(np.searchsorted(hub[0], own[0]), len(hub[0]) - 1)
    shared = np.where(hub[0][at] == own[0], np.minimum(own[1], hub[1][at]), 0.0)
    common, weight, other = shared.sum(), own[1].sum(), hub[1].sum()
    rest = own[1] - shared
    more = rest > 0
    least = similarity / (1 + similarity) * (weight + other) - common - 1e-6 * weight
    return float(common / (weight + other - common)), float(least), own[0][more], rest[more]


def still_open(least: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rests: np.ndarray) -> np.ndarray:
    """Which rows of (keys, rests), `sizes` of them for each node under one hub, can belong to a similar pair.

    All of the hub's nodes have to be given. A key needs two nodes, one of them not linked with the hub (least > 0), and
    such a node needs enough weight in keys that others have. What goes can make more go, so that is repeated.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, key = np.unique(keys, return_inverse=True)
    kept = np.ones(len(keys), bool)
    while True:
        often = np.bincount(key[kept], minlength=len(keys))
        alive = np.bincount(key[kept & (least[owner] > 0)], minlength=len(keys))
        new = kept & (often[key] > 1) & (alive[key] > 0)
        mass = np.bincount(owner[new], rests[new], minlength=len(sizes))
        new &= ((least <= 0) | (mass >= least))[owner]
        if new.sum() == kept.sum():
            return kept
        kept = new


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, *, similarity: float) -> DataFrame:
    """(low, high, weight, similarity, least, keys, rests) of pairs (low, high, weight): low is the hub, the rest is high's.

    A pair sends the node's text to a run of the hub, whose text comes first. A run has about RUN_PAIRS pairs, so a hub of
    very many pairs is spread over many runs. Of a hub's only run, shingles leave the task only where still_open().
    """
    spark = pairs.sparkSession
    width = shuffle_width(spark)
    degree = checkpointed(pairs.groupBy("low").agg((F.floor(F.count("*") / RUN_PAIRS) + 1).cast("int").alias("runs")))
    # only hubs of several runs have to be told to their pairs: one for RUN_PAIRS pairs at most, so a hub of very many is no hot key
    wide = degree.where("runs > 1")
    wide = F.broadcast(wide) if wide.count() <= BROADCAST_ROWS else by_shuffle(wide)
    members = pairs.join(wide, "low", "left").withColumn("runs", F.coalesce("runs", F.lit(1)))
    run = F.pmod(F.xxhash64("high"), F.col("runs")).cast("int")
    members = members.select("low", run.alias("run"), "runs", F.col("high").alias("node"), "weight")
    every = F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run")
    heads = degree.select("low", "runs", every).select("low", "run", "runs", F.col("low").alias("node"), F.lit(0.0).alias("weight"))
    rows = members.unionByName(heads).join(by_shuffle(texts), "node").withColumn("role", (F.col("low") != F.col("node")).cast("int"))
    rows = rows.select("low", "run", "runs", "node", "weight", "text", "role").repartition(width, "low", "run").sortWithinPartitions("low", "run", "role", "node")
    shared = spark.sparkContext.broadcast(idf)
    kinds = (pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float32()))
    names = ["low", "high", "weight", "similarity", "least", "keys", "rests"]

    def sent(out: list[list], whole_hub: bool) -> pa.RecordBatch:
        if whole_hub and out:
            sizes = np.array([len(x[5]) for x in out])
            kept = still_open(np.array([x[4] for x in out]), sizes, np.concatenate([x[5] for x in out]), np.concatenate([x[6] for x in out]).astype(np.float64))
            for x, mine in zip(out, np.split(kept, np.cumsum(sizes)[:-1]), strict=True):
                x[5:] = x[5][mine], x[6][mine]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

    def compare(batches):
        hashes, weights, at, head, out, size, whole_hub = WordHashes(), shared.value, None, None, [], 0, True
        for whole in batches:
            for batch in slices(whole):
                for low, part, runs, node, weight, value, role in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    own = weighted(split_words(value), hashes, weights)
                    if not role:
                        yield sent(out, whole_hub)
                        at, head, out, size, whole_hub = (low, part), own, [], 0, runs == 1
                    elif at == (low, part):
                        found, least, keys, rests = beyond(head, own, similarity)
                        keys = (keys ^ np.uint64(xxhash.xxh3_64_intdigest(low))) * np.uint64(_ODD)
                        out.append([low, node, weight, found, least, keys.view(np.int64), rests.astype(np.float32)])
                        size += len(keys)
                        if size > RUN_KEYS:  # the run is told apart by the tables alone
                            whole_hub = False
                            yield sent(out, False)
                            out, size = [], 0
        yield sent(out, whole_hub)

    return rows.mapInArrow(compare, "low binary, high binary, weight double, similarity double, least double, keys array<long>, rests array<float>")


def _shared_keys(rows: DataFrame, owner: str) -> DataFrame:
    """The rows of keys that two owners have at least, with how often the key occurs."""
    often = rows.groupBy("key").agg(F.min(owner).alias("lo"), F.max(owner).alias("hi"), F.count("*").alias("often")).where("lo <> hi").select("key", "often")
    return rows.join(by_shuffle(often), "key")


def _open_keys(compared: DataFrame) -> DataFrame:
    """(key, node, weight, alive): nodes under a hub that can be similar to others there, with those others.

    A key is a hub with a shingle beyond it. A node that isn't linked with the hub is alive if it shares enough beyond it.
    """
    compared = compared.withColumn("pair", F.xxhash64("low", "high"))
    rows = compared.select("pair", F.explode(F.arrays_zip("keys", "rests")).alias("x")).select("pair", F.col("x.keys").alias("key"), F.col("x.rests").alias("rest"))
    rows = checkpointed(_shared_keys(rows, "pair"))
    mass = rows.groupBy("pair").agg(F.sum("rest").alias("mass"))
    able = compared.select("pair", F.col("high").alias("node"), "weight", "least").join(by_shuffle(mass), "pair").where("least <= 0 or mass >= least")
    placed = rows.join(by_shuffle(able.select("pair", "node", "weight", "least", (F.col("least") > 0).alias("alive"))), "pair")
    # of an alive node's keys, rare ones first, the last that weigh too little together can be left out: a pair meets before
    tail = F.sum("rest").over(Window.partitionBy("pair").orderBy(F.desc("often"), F.desc("key")))
    placed = placed.withColumn("tail", tail).where("not alive or tail >= least")
    placed = checkpointed(placed.select("key", "node", "weight", "alive"))
    drop_kept(rows)
    return placed


def _apart(placed: DataFrame, parts: DataFrame) -> tuple[DataFrame, int]:
    """The rows of keys with an alive node and nodes of two components, with components (part), and the pairs to verify."""
    placed = placed.join(by_shuffle(parts.withColumnRenamed("component", "part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
    within = placed.groupBy("key", "part").agg(F.count("*").alias("n"), F.count_if("alive").alias("live"))
    state = within.groupBy("key").agg(F.sum("n").alias("n"), F.sum("live").alias("live"), F.sum(F.col("n") * F.col("live")).alias("inside"))
    state = state.withColumn("pairs", F.col("n") * F.col("live") - F.col("inside")).where("pairs > 0")
    state = checkpointed(state.select("key", "pairs"))
    left = checkpointed(placed.join(by_shuffle(state.select("key")), "key"))
    return left, state.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, rare_share: float = RARE_SHARE) -> DataFrame:
    """(doc_id, class_id, class_size): every row of docs with its class and the number of rows in it.

    With a `rare_share` of 0 all inverse document frequencies count as they are.
    """
    return _classes(docs, doc_id=doc_id, text=text, similarity=similarity, rare_share=rare_share).select("doc_id", "class_id", "class_size")


def _classes(docs: DataFrame, *, doc_id: str, text: str, similarity: float, rare_share: float = RARE_SHARE) -> DataFrame:
    """(doc_id, raw, node, class_id, class_raw, class_size) of every row. The class is named by its smallest doc_id, and of
    the texts with that by the smallest digest."""
    n, frequencies = document_frequencies(docs, text)
    idf = idf_weights(n, frequencies, rare_share)
    rows = checkpointed(signatures(docs, idf, doc_id=doc_id, text=text))
    each = rows.where("node is not null").groupBy("node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "raw"))
    nodes = checkpointed(each.agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("weight").alias("weight"), F.count("*").alias("copies"), first.alias("first")))
    # a key is a band's samples mixed with the band, so it names the bucket
    placed = nodes.select("node", "weight", F.explode("bands").alias("key"))
    hubs = placed.groupBy("key").agg(F.min(F.struct("weight", "node")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    hubs = checkpointed(hubs.select("key", F.col("hub.node").alias("low"), "n"))
    # the hubs of buckets that a large share of all nodes is in, HOT_KEYS at most, go to the nodes; no task gets such a bucket
    total = BANDS * nodes.count()
    hot, rest = F.broadcast(hubs.where(F.col("n") * HOT_KEYS >= total).drop("n")), hubs.where(F.col("n") * HOT_KEYS < total).drop("n")
    met = placed.join(hot, "key").unionByName(placed.join(hot.select("key"), "key", "left_anti").join(by_shuffle(rest), "key")).where("node <> low")
    stars = checkpointed(met.select("low", F.col("node").alias("high"), "weight").distinct())
    inside = nodes.join(by_shuffle(stars.select(F.col("high").alias("node")).union(stars.select("low")).distinct()), "node", "left_semi")
    texts = checkpointed(texts_of(inside, docs, doc_id=doc_id, text=text))
    most = PAIRS_A_NODE * nodes.count()
    links, parts = None, None

    def linked(pairs: DataFrame) -> DataFrame:
        nonlocal links, parts
        compared = checkpointed(verified(pairs, texts, idf, similarity=similarity))
        new = compared.where(F.col("similarity") >= similarity).select("low", "high")
        links = checkpointed(new if links is None else links.unionByName(new).distinct())
        parts = connected_components(links, "low", "high")
        return compared

    for turn in range(MOST_ROUNDS):
        compared = linked(stars)
        opened = _open_keys(compared)
        drop_kept(compared)
        left, pairs = _apart(opened, parts)
        if pairs > most:
            # other hubs join what the lightest left apart, and leave fewer pairs of two components
            seeds = [F.min_by("node", F.xxhash64("node", F.lit(seed))).alias(f"hub{seed}") for seed in range(SWEEP_HUBS)]
            hubs = left.groupBy("key").agg(*seeds).select("key", F.explode(F.array(*[f"hub{k}" for k in range(SWEEP_HUBS)])).alias("hub"))
            hubs = hubs.distinct().join(by_shuffle(left.select("key", F.col("node").alias("hub"), F.col("part").alias("of"))), ["key", "hub"])
            near = left.join(by_shuffle(hubs), "key").where("part <> of")
            near = near.select(F.least("hub", "node").alias("low"), F.greatest("hub", "node").alias("high"), F.lit(0.0).alias("weight")).distinct()
            drop_kept(linked(checkpointed(near)))
            left, pairs = _apart(opened, parts)
        drop_kept(opened)
        if not pairs:
            break
        if pairs <= most or turn + 1 == MOST_ROUNDS:
            a, b = left.where("alive").alias("a"), by_shuffle(left).alias("b")
            near = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.part") != F.col("b.part")))
            near = near.select(F.least("a.node", "b.node").alias("low"), F.greatest("a.node", "b.node").alias("high"), F.lit(0.0).alias("weight")).distinct()
            drop_kept(linked(checkpointed(near)))
            break
        hubs = left.groupBy("key").agg(F.min(F.struct("weight", "node")).alias("hub")).select("key", F.col("hub.node").alias("low"))
        stars = checkpointed(left.join(by_shuffle(hubs), "key").where("node <> low").select("low", F.col("node").alias("high"), "weight").distinct())
    drop_kept(texts)

    member = nodes.select("node", "copies", "first").join(by_shuffle(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = member.groupBy("component").agg(F.min("first").alias("first"), F.sum("copies").alias("class_size"))
    classes = classes.select("component", F.col("first.doc_id").alias("class_id"), F.col("first.raw").alias("class_raw"), "class_size")
    by_node = checkpointed(member.join(by_shuffle(classes), "component").select("node", "copies", "class_id", "class_raw", "class_size"))
    # nodes of very many rows, HOT_NODES at most, are joined by a broadcast, so no task gets all rows of one
    total = rows.count()
    hot = by_node.where(F.col("copies") * HOT_NODES >= total).drop("copies")
    own = rows.select("doc_id", "raw", "node")
    named = own.join(F.broadcast(hot), "node").unionByName(own.join(F.broadcast(hot), "node", "left_anti").join(by_shuffle(by_node.drop("copies")), "node", "left"))
    return named.select(
        "doc_id",
        "raw",
        "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_raw",
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
    )


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near copies: of each class one row stays, of its smallest doc_id. Columns stay as they are.

    Rows are told apart by doc_id and text, so another text under the same doc_id, or without one, is a document of its
    own. Of rows equal in both one stays. Rows without words all stay.
    """
    rows = _classes(docs, doc_id=doc_id, text=text, similarity=SIMILARITY).where("node is not null")
    kept = F.col("class_id").eqNullSafe(F.col("doc_id")) & (F.col("class_raw") == F.col("raw"))
    each = rows.groupBy(F.col("doc_id").alias("__id"), F.col("raw").alias("__raw")).agg(F.bool_or(kept).alias("kept"), F.count("*").alias("n"))
    each = checkpointed(each.where("not kept or n > 1"))
    small = F.broadcast if each.count() <= BROADCAST_ROWS else by_shuffle
    names = docs.columns
    plain = docs.toDF(*[f"__{k}" for k in range(len(names))])
    own_id, own_text = (f"__{names.index(c)}" for c in (doc_id, text))
    plain = plain.withColumn("__own", _raw(F.col(own_text)))
    same = F.col(own_id).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__raw"))
    left = plain.join(small(each.where("not kept")), same, "left_anti")
    repeated = each.where("kept").select("__id", "__raw")
    if not repeated.isEmpty():
        twice = left.join(small(repeated), same, "left_semi").dropDuplicates([own_id, "__own"])
        left = left.join(small(repeated), same, "left_anti").unionByName(twice)
    return left.drop("__own").toDF(*names)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
