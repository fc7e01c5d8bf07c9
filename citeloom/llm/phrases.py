"""Phrase collocations from count tries of limited depth.

Every task counts the words that it reads in tries: a node is a phrase of up to `depth` words of a language, with the number
of places where it begins. A trie holds `RUN_WORDS` words at most and is then serialised sorted, node after node: the depth,
the node's last word and its count. The rest of the path is that of the nodes before it, so a prefix is stored once. The
runs are written to the shared folder in blocks; the paths that blocks begin with are an even sample of all nodes, from which
prefix ranges of about `RANGE_NODES` nodes are drawn. Each block is cut at the bounds of the ranges, and the sorted slices of
a range are merged to one trie, whose counts cover all documents. A range that begins inside a prefix is also sent the counts
of that prefix by every run, so that each merged trie has whole paths.

Left parts of a phrase are met on the walk from the root of the merged trie. Right parts are its suffix link: a phrase of
three words links to the pair without its first word, and the pair to its last word; links lead to other ranges and are
followed by joins. Only phrases of `least` occurrences are joined: their parts occur as often at least.

Ranges balance work only; results don't depend on them. No word is a hot key: a run has it once, with its count.

Defined cases: null and empty texts have no words; a null language is `und`, as is a language of that name; texts of any
length are read in stretches, and phrases across stretches are counted; repeated rows count each time; ties are ranked by
the phrase's bytes; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, shuffle_width, slices, spread_join, table

#: Words of a run: three ranks of its words are one number of 63 bits.
RUN_WORDS = (1 << 21) - 4
#: Nodes of a block, between two marks of its paths, of a range; and ranges at most: their bounds are what is broadcast.
BLOCK_NODES, MARK_NODES = 1 << 18, 1 << 13
RANGE_NODES = 1 << 20
MOST_RANGES = 1 << 20
#: Bytes of a text that are split together.
STRETCH = 1 << 20
LEAST, MOST_WORDS, TOP = 10, 3, 2000
#: A phrase goes where a longer one holds it in this many of 100 places.
HELD_SHARE = 50

#: Lower-cases A-Z; ends of pieces become newlines, tabs spaces.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_CARRIED = 8
_CODEC = "zstd"


class Numbers(dict):
    """Words by number, in the order in which they are met; 0 ends a piece and 1 is the empty word."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def stretches(text: bytes, most: int = STRETCH) -> Iterator[bytes]:
    """The text in parts that end behind a space or the end of a piece."""
    text = text.translate(_CLEAN)
    at = 0
    while len(text) - at > most:
        end = max(text.rfind(b" ", at, at + most), text.rfind(b"\n", at, at + most)) + 1
        if not end:  # one word longer than that
            ends = [k for k in (text.find(b" ", at + most), text.find(b"\n", at + most)) if k >= 0]
            end = min(ends) + 1 if ends else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class Nodes:
    """Nodes of a trie in sorted order. The words of each depth are a sorted list; a path is a key of ranks in them, from 1,
    with 0 for none, packed into one number. Carried nodes belong to an earlier range and are on the way to this one."""

    def __init__(self, words: tuple[list[bytes], list[bytes], list[bytes]], keys: np.ndarray, counts: np.ndarray, carried: np.ndarray | None = None) -> None:
        self.words, self.keys, self.counts = words, keys, counts
        self.carried = np.zeros(len(keys), bool) if carried is None else carried
        self.shifts = shifts_of(words)

    def ranks(self) -> list[np.ndarray]:
        one, two, _ = self.shifts
        return [self.keys >> one, self.keys >> two & (1 << one - two) - 1, self.keys & (1 << two) - 1]

    def depths(self) -> np.ndarray:
        _, two, three = self.ranks()
        return 1 + (two > 0) + (three > 0)

    def path(self, at: int) -> tuple[bytes, ...]:
        key, out = int(self.keys[at]), []
        for words, shift in zip(self.words, self.shifts, strict=True):
            if rank := key >> shift:
                out.append(words[rank - 1])
            key &= (1 << shift) - 1
        return tuple(out)

    def part(self, low: int, high: int) -> Nodes:
        return Nodes(self.words, self.keys[low:high], self.counts[low:high], self.carried[low:high])

    def place(self, path: tuple[bytes, ...]) -> int:
        """How many nodes come before this path."""
        key = 0
        for words, shift, word in zip(self.words, self.shifts, path, strict=False):
            rank = bisect_left(words, ended(word), key=ended)
            key |= rank + 1 << shift
            if rank == len(words) or words[rank] != word:
                break
        return int(np.searchsorted(self.keys, key))

    def packed(self) -> bytes:
        """The nodes one after the other: depth, last word, count. What is missing on the way to the first is put before it."""
        keys, counts, flags = self.keys, self.counts, self.carried
        first = int(keys[0])
        above = sorted({first >> s << s for s in self.shifts[:2]} - {first})
        if above:
            keys = np.concatenate([np.array(above, np.int64), keys])
            counts = np.concatenate([np.zeros(len(above), np.int64), counts])
            flags = np.concatenate([np.ones(len(above), bool), flags])
        all_ = Nodes(self.words, keys, counts)
        depth, own, lists = all_.depths(), np.zeros(len(keys), np.uint32), []
        for d, (rank, words) in enumerate(zip(all_.ranks(), self.words, strict=True), 1):
            mine = depth == d
            used, where = np.unique(rank[mine], return_inverse=True)
            own[mine] = where
            lists.append(b"\n".join([words[r - 1] for r in used.tolist()]))
        head = np.array([len(keys), *map(len, lists)], np.int64)
        made = b"".join([head.tobytes(), (depth + _CARRIED * flags).astype(np.uint8).tobytes(), own.tobytes(), counts.astype(np.int64).tobytes(), *lists])
        return len(made).to_bytes(8, "little") + pa.compress(made, _CODEC, asbytes=True)


def ended(word: bytes) -> bytes:
    """Words are in the order of their bytes with an end, so that paths are in the order of theirs."""
    return word + b"\n"


def shifts_of(words: tuple[list[bytes], ...]) -> tuple[int, int, int]:
    bits = [(len(w) + 1).bit_length() for w in words]  # room for a place behind all
    if sum(bits) > 63:
        raise OverflowError(f"a range holds {[len(w) for w in words]} different words by depth: give smaller ranges")
    return bits[1] + bits[2], bits[2], 0


def unpacked(data: bytes) -> Nodes:
    made = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), _CODEC, asbytes=True)
    n, *sizes = np.frombuffer(made, np.int64, 4).tolist()
    marks = np.frombuffer(made, np.uint8, n, 32)
    own = np.frombuffer(made, np.uint32, n, 32 + n).astype(np.int64) + 1
    counts = np.frombuffer(made, np.int64, n, 32 + 5 * n)
    words, at = [], 32 + 13 * n
    for size in sizes:
        words.append(made[at : at + size].split(b"\n") if size else [])
        at += size
    depth, carried = marks & (_CARRIED - 1), marks >= _CARRIED
    one, two, _ = shifts_of(words)
    # the last node of each depth up to a node is on its path
    keys = own[last_where(depth == 1)] << one | np.where(depth > 1, own[last_where(depth == 2)], 0) << two | np.where(depth > 2, own, 0)
    return Nodes(tuple(words), keys, counts, carried)


def last_where(mark: np.ndarray) -> np.ndarray:
    """The last marked place up to each place."""
    return np.maximum.accumulate(np.where(mark, np.arange(len(mark)), 0))


def merged(runs: list[Nodes]) -> Nodes:
    """One trie of several: paths in one ranking of all their words; a merge of sorted runs; counts of equal paths added."""
    if len(runs) == 1:
        return runs[0]
    words = tuple(sorted(set().union(*[r.words[d] for r in runs]), key=ended) for d in range(3))
    shifts, parts = shifts_of(words), []
    rank = [dict(zip(w, range(1, len(w) + 1), strict=True)) for w in words]
    for r in runs:
        new = [np.array([0, *map(rank[d].__getitem__, r.words[d])], np.int64) for d in range(3)]
        parts.append(sum(new[d][old] << shifts[d] for d, old in enumerate(r.ranks())))
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")  # merges the ascending runs that it finds
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.add.reduceat(np.concatenate([r.counts for r in runs])[order], starts)
    return Nodes(words, keys[starts], counts, np.logical_and.reduceat(np.concatenate([r.carried for r in runs])[order], starts))


def trie(numbers: Numbers, ids: np.ndarray, starts: int) -> Nodes:
    """The trie of the phrases that begin at the first `starts` of the numbered words; a 0 ends a piece."""
    words = sorted(list(numbers)[2:], key=ended)
    one, two, _ = shifts_of((words, words, words))
    rank = np.zeros(len(numbers), np.int64)
    rank[[numbers[w] for w in words]] = np.arange(1, len(words) + 1)
    # few arrays of a run's length are alive at once: what a worker once took it seldom gives back
    r = np.concatenate([rank[ids], np.zeros(2, np.int64)])
    place = r[2:] * (r[1:-1] > 0)
    place[:] |= r[1:-1] << two
    place[:] |= r[:-2] << one
    place = place[:starts][r[:starts] > 0]
    del r
    place.sort()
    begins = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
    leaf, n = place[begins], np.diff(begins, append=len(place)).astype(np.int32)
    del place, begins
    # a leaf stands behind the nodes above it that begin with it; a path of one or two words is a node above alone
    news = []
    for shift, above in ((one, 63), (two, one)):
        up = leaf >> shift
        new = np.append(True, up[1:] != up[:-1])[: len(up)]
        news.append((shift, new, new & (up & (1 << above - shift) - 1 > 0)))
        del up
    own = leaf & (1 << two) - 1 > 0
    size = own.astype(np.int8)
    for _, _, real in news:
        size += real
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    keys, counts = np.zeros(total, np.int64), np.zeros(total, np.int32)
    at = ends - size
    for shift, new, real in news:
        where = at[real]
        keys[where] = leaf[real] >> shift << shift
        if len(leaf):
            counts[where] = np.add.reduceat(n, np.flatnonzero(new))[real[new]]
        at += real
    keys[at[own]], counts[at[own]] = leaf[own], n[own]
    return Nodes((words, words, words), keys, counts)


class Shard:
    """What a task has read since it last wrote a run: numbered words of each language."""

    def __init__(self) -> None:
        self.kept: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes, end: bool) -> None:
        numbers, parts = self.kept.setdefault(lang, (Numbers(), []))
        ids = np.fromiter(map(numbers.__getitem__, text.replace(b"\n", b" \n ").split(b" ")), np.int32)
        ids = ids[ids != 1]
        if end:
            ids = np.append(ids, np.int32(0))
        parts.append(ids)
        self.size += len(ids)

    def runs(self) -> Iterator[tuple[str, Nodes]]:
        """Tries of what was read; the last two words of a piece that isn't at its end stay for the next run."""
        old, self.kept, self.size = self.kept, {}, 0
        for lang in list(old):
            numbers, parts = old.pop(lang)
            ids = np.concatenate(parts)
            del parts
            tail = ids[-2:]
            open_ = len(tail) and tail[-1] != 0
            keep = 0 if not open_ else len(tail) if tail[0] != 0 else 1
            found = trie(numbers, ids, len(ids) - keep)
            if len(found.keys):
                yield lang, found
            if keep:
                names = list(numbers)
                self.add(lang, b" ".join(names[k] for k in ids[-keep:].tolist()), False)


def _rows(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


_BLOCK = {"lang": pa.string(), "marks": pa.list_(pa.list_(pa.binary())), "nodes": pa.int64(), "block": pa.binary()}


def tries(docs: DataFrame, *, lang: str = "lang", text: str = "text", run_words: int = RUN_WORDS) -> DataFrame:
    """(lang, marks, nodes, block): sorted runs of count tries, in blocks, with the path of each `MARK_NODES`-th node."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()

        def flush() -> Iterator[pa.RecordBatch]:
            for name, found in shard.runs():
                for at in range(0, len(found.keys), BLOCK_NODES):
                    part = found.part(at, at + BLOCK_NODES)
                    marks = [list(part.path(k)) for k in range(0, len(part.keys), MARK_NODES)]
                    yield _rows([(name, marks, len(part.keys), part.packed())], _BLOCK)

        def room(size: int) -> Iterator[pa.RecordBatch]:
            if shard.size and shard.size + size > run_words:
                yield from flush()

        for whole in batches:
            for batch in slices(whole, STRETCH):
                names = batch.column(0).to_pylist()
                texts = batch.column(1)
                by_lang: dict[str, list[bytes]] = {}
                for k, name in enumerate(names):
                    value = texts[k].as_py()
                    if not value:
                        continue
                    if len(value) < STRETCH:
                        by_lang.setdefault(name, []).append(value.translate(_CLEAN))
                        continue
                    last = None
                    for part in stretches(value):
                        if last is not None:
                            yield from room(len(last))
                            shard.add(name, last, False)
                        last = part
                    yield from room(len(last) + 1)
                    shard.add(name, last, True)
                for name, values in by_lang.items():
                    yield from room(sum(map(len, values)) + len(values))  # words and ends can't be more
                    shard.add(name, b"\n".join(values), True)
        yield from flush()

    rows = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].cast("binary").alias("text"))
    return rows.mapInArrow(read, "lang string, marks array<array<binary>>, nodes long, block binary")


Bound = tuple[str, tuple[bytes, ...]]


def order_of(bound: Bound) -> tuple:
    return bound[0], tuple(w + b"\n" for w in bound[1])


def bounds_of(blocks: DataFrame, range_nodes: int = RANGE_NODES) -> list[Bound]:
    """Where all ranges but the first begin, from a sample of the marks: 64 a range, 2^22 at most."""
    marks = blocks.select("lang", F.posexplode("marks").alias("k", "mark"), "nodes")
    nodes, rows = marks.agg(F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("nodes"))), F.lit(0)), F.count("*")).first()
    ranges = min(MOST_RANGES, -(-nodes // range_nodes))
    if ranges < 2:
        return []
    share = min(1.0, min(64 * ranges, 1 << 22) / rows)
    # even among equal paths too: the sample is drawn by row
    picked = marks.select("lang", "mark") if share == 1.0 else marks.select("lang", "mark").sample(share, seed=1)
    firsts = sorted([(r["lang"], tuple(map(bytes, r["mark"]))) for r in picked.toLocalIterator()], key=order_of)
    return sorted({firsts[len(firsts) * k // ranges] for k in range(1, ranges)} if firsts else (), key=order_of)


def cut(lang: str, nodes: Nodes, bounds: list[Bound]) -> Iterator[tuple[int, Nodes]]:
    """(range, nodes): a block's slices, and its nodes on the way to a bound, for the range that begins there."""
    low = bisect_left(bounds, order_of((lang, nodes.path(0))), key=order_of)
    last = nodes.path(len(nodes.keys) - 1)
    end = bisect_left(bounds, (lang, (ended(last[0]) + b"\0",)), key=order_of)  # behind all paths that begin as the last one
    at = [0, *[nodes.place(path) for _, path in bounds[low:end]], len(nodes.keys)]
    for k, (here, there) in enumerate(zip(at, at[1:], strict=False)):
        if here < there:
            yield low + k, nodes.part(here, there)
    for k in range(low, end):
        path = bounds[k][1]
        ways = [(nodes.place(path[:d]), path[:d]) for d in range(1, len(path))]
        ways = [w for w, way in ways if w < len(nodes.keys) and not nodes.carried[w] and nodes.path(w) == way]
        if ways:
            yield k + 1, Nodes(nodes.words, nodes.keys[ways], nodes.counts[ways], np.ones(len(ways), bool))


_PHRASE = {"lang": pa.string(), "phrase": pa.string(), "words": pa.int32(), "a": pa.int64(), "left1": pa.int64(), "left2": pa.int64()}


def merged_phrases(blocks: DataFrame, *, least: int = LEAST, range_nodes: int = RANGE_NODES) -> DataFrame:
    """(lang, phrase, words, a, left1, left2) of the phrases of `least` occurrences: how many words they have, how often they
    occur, and how often their first word and first two words. Rows of no words are parts of a language's sum of words."""
    spark = blocks.sparkSession
    bounds = bounds_of(blocks, range_nodes)
    shared = spark.sparkContext.broadcast(bounds)

    def slice_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [(k, name, part.packed()) for k, part in cut(name, unpacked(block.as_py()), shared.value)]
                yield _rows(rows, {"range": pa.int64(), "lang": pa.string(), "slice": pa.binary()})

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, size = [], None, 0

        def answer() -> Iterator[pa.RecordBatch]:
            yield from walked(name[1], merged(held), least)

        for batch in batches:
            for k, lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if name is not None and (k, lang) != name:
                    yield from answer()
                    held, size = [], 0
                name = (k, lang)
                held.append(unpacked(value.as_py()))
                size += len(held[-1].keys)
                if size > 2 * range_nodes and len(held) > 1:  # equal paths are one from here on
                    held = [merged(held)]
                    size = len(held[0].keys) // 2
        if name is not None:
            yield from answer()

    cuts = blocks.select("lang", "block").mapInArrow(slice_, "range long, lang string, slice binary")
    ranges = cuts.repartition(shuffle_width(spark), "range", "lang").sortWithinPartitions("range", "lang")
    return ranges.mapInArrow(merge, "lang string, phrase string, words int, a long, left1 long, left2 long")


def walked(lang: str, nodes: Nodes, least: int) -> Iterator[pa.RecordBatch]:
    """What a merged trie has to say: the counts of its frequent nodes and of the nodes on the way to them."""
    depth, own = nodes.depths(), ~nodes.carried
    one, two = nodes.counts[last_where(depth == 1)], nodes.counts[last_where(depth == 2)]
    said = np.flatnonzero(own & (nodes.counts >= least))
    yield _rows([(lang, None, 0, int(nodes.counts[own & (depth == 1)].sum()), None, None)], _PHRASE)
    for at in range(0, len(said), 1 << 14):
        rows = []
        for k in said[at : at + (1 << 14)].tolist():
            d = int(depth[k])
            rows.append((lang, b" ".join(nodes.path(k)).decode("utf-8", "replace"), d, int(nodes.counts[k]), int(one[k]) if d > 1 else None, int(two[k]) if d > 2 else None))
        yield _rows(rows, _PHRASE)


def collocations(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, held_share: int = HELD_SHARE, range_nodes: int = RANGE_NODES, run_words: int = RUN_WORDS
) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of all phrases of two or three words that occur `least` times and aren't held
    by a longer one in `held_share` of 100 places. The score is that of the cut with the lowest, the first of equal ones."""
    blocks = checkpointed(tries(docs, lang=lang, text=text, run_words=run_words))
    said = checkpointed(merged_phrases(blocks, least=least, range_nodes=range_nodes))
    sums = said.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))

    def key(phrase: Column) -> Column:
        return F.struct(F.col("lang").alias("lang"), phrase.alias("phrase")).alias("link")

    suffix = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    singles = said.where("words = 1").select(key(F.col("phrase")), F.col("a").alias("r1"))
    pairs = said.where("words = 2").withColumn("link", key(suffix))
    triples = said.where("words = 3").withColumn("link", key(suffix))
    # the suffix link of a pair is its last word; that of a triple is a pair, which has followed its own link
    pairs = checkpointed(spread_join(checkpointed(pairs), singles, "link").drop("link"))
    linked = pairs.select(key(F.col("phrase")), F.col("a").alias("r1"), F.col("r1").alias("r2"))
    triples = checkpointed(spread_join(checkpointed(triples), linked, "link").drop("link"))
    # the longest phrases aren't held by longer ones; a pair is held as the beginning or the end of a triple
    begins = F.expr("substring_index(phrase, ' ', 2)")
    holders = triples.select("lang", F.explode(F.array(begins, suffix)).alias("phrase"), F.col("a").alias("most")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    free = pairs.join(holders, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("most") < held_share * F.col("a"), F.lit(True))).drop("most")
    number = "cast({} as decimal(15,0))".format  # a count: the products below have 38 digits at most

    def score(l: str, r: str) -> Column:
        return F.expr(f"{number('a')} * {number('a')} * cast(1000000 as decimal(7,0)) div ({number(l)} * {number(r)})").alias("score")

    first = F.struct(score("left1", "r1").alias("score"), F.lit(1).alias("k"), F.col("left1").alias("l"), F.col("r1").alias("r"))
    second = F.struct(score("left2", "r2").alias("score"), F.lit(2).alias("k"), F.col("left2").alias("l"), F.col("r2").alias("r"))
    found = free.withColumn("cut", first).drop("r1").unionByName(triples.withColumn("cut", F.least(first, second)).drop("r1", "r2"))
    return found.join(sums, "lang").select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` of each language, with rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best(collocations(table(spark, sf_dir, "documents")))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: All phrases by their places in pieces, cuts by joins, integers of 128 bits.
OP11_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
grams AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM p CROSS JOIN (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY 1),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {LEAST}),
held AS (SELECT DISTINCT s.lang, s.phrase FROM c AS s JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE size = 3) AS longer USING (lang, phrase) WHERE 100 * longer.a >= {HELD_SHARE} * s.a),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS before, array_to_string(w[k + 1:], ' ') AS behind FROM c ANTI JOIN held USING (lang, phrase), unnest(range(1, size)) AS t(k)),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, b.f AS l, e.f AS r, ((1000000::HUGEINT * cuts.a * cuts.a) // (b.f::HUGEINT * e.f))::BIGINT AS score, k
  FROM cuts JOIN f AS b ON b.lang = cuts.lang AND b.phrase = before JOIN f AS e ON e.lang = cuts.lang AND e.phrase = behind),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM lowest) JOIN n USING (lang) WHERE rank <= {TOP}"""
