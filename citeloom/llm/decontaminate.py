"""Benchmark decontamination by Wu-Manber search with words as symbols.

Every benchmark item gives its windows of 13 consecutive words (one window of all its words if it has fewer). Windows of
one length form a matcher: the shift table says, for a block of two words, how far the search may jump; a block with shift
0 opens the bucket of windows that end in it, the window's first block narrows that bucket, and a direct comparison
confirms. On text without benchmark words a search of 13-word windows looks at every twelfth word.

The items are broadcast in blocks whose texts have a checked size (`block_bytes`). Windows, buckets and shifts are places in
sorted arrays of word numbers, so a searcher takes about ten times its text, and tasks of one worker share it. A benchmark
beyond one block is searched block after block, each in a pass over the documents that writes its hits alone, and the hits of
all blocks are joined to the documents in the end; so no task ever holds more than one block.

Defined cases: a null or empty text has no words, no hits and isn't contaminated; null and wordless items have no windows;
items of equal text are all reported; a null item_id is searched but not reported; repeated documents are judged
one by one; texts of any length are searched whole, in memory of a few times their length (about 60 bytes a word); empty
tables give no rows or no hits; other columns of either table are ignored.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, checkpointed, split_words, table

WINDOW_WORDS = 13
#: Bytes of benchmark text that a task holds at a time.
BLOCK_BYTES = 4 << 20

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS), T.StructField("hit_items", T.ArrayType(T.StringType()))]
SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def pair_keys(first: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    return first.astype(np.int64) if second is None else first.astype(np.int64) << 32 | second


class WuManber:
    """Windows of one length over numbered words: places in one array of the items' words, in sorted arrays.

    starts, ends are those of the items' words in `words`; owners are found by the item's number.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, items: np.ndarray, length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.farthest = length - self.block + 1
        self.words = words
        at = np.concatenate([np.arange(s, e - length + 1) for s, e in zip(starts, ends, strict=True)])
        owner = np.repeat(items, ends - starts - length + 1)
        last, first = self._keys(at + length - self.block), self._keys(at)
        # equal windows come together: by their ends, their beginnings, and a hash of all their words
        mixed = np.zeros(len(at), np.uint64)
        for k in range(length):
            mixed = (mixed ^ words[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((owner, mixed, first, last))
        at, last, first, owner = at[order], last[order], first[order], owner[order]
        fresh = np.ones(len(at), bool)
        for low in range(1, len(at), 1 << 16):
            high = min(len(at), low + (1 << 16))
            rows = np.arange(length)
            fresh[low:high] = (words[at[low:high, None] + rows] != words[at[low - 1 : high - 1, None] + rows]).any(axis=1)
        heads = np.flatnonzero(fresh)
        self.at = at[heads].astype(np.int64)
        self.last, self.first = array("q", last[heads].tobytes()), array("q", first[heads].tobytes())
        self.owner_ends = np.append(heads[1:], len(at))
        self.owner_starts, self.owners = heads, owner.astype(np.int32)
        # the least jump of a block: how far the window that begins first in its item still goes
        spots = np.concatenate([np.arange(s, e - self.block + 1) for s, e in zip(starts, ends, strict=True)])
        begins = np.repeat(starts, ends - starts - self.block + 1)
        jumps = np.maximum(0, begins + length - self.block - spots)
        keys = self._keys(spots)
        order = np.lexsort((jumps, keys))
        keys, jumps = keys[order], jumps[order]
        kept = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.blocks, self.jumps = array("q", keys[kept].tobytes()), jumps[kept].astype(np.uint8 if length < 256 else np.int32)

    def _keys(self, at: np.ndarray) -> np.ndarray:
        return pair_keys(self.words[at], self.words[at + 1] if self.block == 2 else None)

    def shift(self, key: int) -> int:
        k = bisect_left(self.blocks, key)
        return int(self.jumps[k]) if k < len(self.blocks) and self.blocks[k] == key else self.farthest

    def search(self, words: list[bytes], number: dict[bytes, int]) -> Iterator[tuple[int, int]]:
        """(end, window) of occurrences, in order."""
        length, block, farthest, get = self.length, self.block, self.farthest, number.get
        end, total = length, len(words)
        while end <= total:
            last = get(words[end - 1])
            if last is None:  # no window holds the word
                end += length
                continue
            if block == 2:
                before = get(words[end - 2])
                if before is None:
                    end += farthest
                    continue
                last |= before << 32
            jump = self.shift(last)
            if jump:
                end += jump
                continue
            for window in self._windows(words, end, last, number):
                yield end, window
            end += 1

    def _windows(self, words: list[bytes], end: int, last: int, number: dict[bytes, int]) -> Iterator[int]:
        here = [number.get(w) for w in words[end - self.length : end]]
        if None in here:
            return
        first = here[0] << 32 | here[1] if self.block == 2 else here[0]
        low, high = bisect_left(self.last, last), bisect_right(self.last, last)
        low, high = bisect_left(self.first, first, low, high), bisect_right(self.first, first, low, high)
        for k in range(low, high):
            start = self.at[k]
            if self.words[start : start + self.length].tolist() == here:
                yield k

    def owners_of(self, window: int) -> np.ndarray:
        return self.owners[self.owner_starts[window] : self.owner_ends[window]]


class Searcher:
    """All items of a block: about 60 bytes a word and a dictionary of the different words."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int) -> None:
        self.names: list[str | None] = []
        self.number: dict[bytes, int] = {}
        parts: list[np.ndarray] = []
        for item, text in items:
            words = split_words(text)
            if words:
                self.names.append(item)
                parts.append(np.fromiter((self.number.setdefault(w, len(self.number)) for w in words), np.int32, len(words)))
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.matchers = []
        for length in np.unique(np.minimum(sizes, window)).tolist():
            mine = np.flatnonzero(np.minimum(sizes, window) == length)
            self.matchers.append(WuManber(words, ends[mine] - sizes[mine], ends[mine], mine, length))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words, and the items with occurring windows."""
        found: set[str] = set()
        spans: list[tuple[int, int]] = []
        for matcher in self.matchers:
            seen: set[int] = set()
            for end, window in matcher.search(words, self.number):
                spans.append((end - matcher.length, end))
                seen.add(window)
            for window in seen:
                found.update(name for k in matcher.owners_of(window) if (name := self.names[k]) is not None)
        return merged(spans), found


#: The searcher of the block that this worker saw last: tasks of one worker share it.
_LAST: dict[str, Searcher] = {}


def _searcher(key: str, items: list, window: int) -> Searcher:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Searcher(items, window)
    return _LAST[key]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _searched(docs: DataFrame, items: list, keep: list[str], text: str, window: int) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def setup():
        searcher = _searcher(key, shared.value, window)

        def run(texts):
            counts, spans, found = [], [], []
            for value in texts.to_pylist():
                words = split_words(value)
                runs, names = searcher.search(words)
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in runs])
                found.append(sorted(names))
            return [pa.array(counts, pa.int64()), pa.array(spans, SPANS_ARROW), pa.array(found, pa.list_(pa.string()))]

        return run

    return arrow_map(docs, [text], keep, FOUND, setup)


def _block_after_block(docs: DataFrame, items: DataFrame, blocks: int, of_block: Column, keep: list[str], text: str, window: int) -> DataFrame:
    """The same for items of several blocks. Documents get a row number and are written once; a block adds its hits alone."""
    spread = docs.select(*[docs[c] for c in dict.fromkeys([*keep, text])]).withColumn("__row", F.monotonically_increasing_id())
    rows, hits = checkpointed(spread), None
    for block in range(blocks):
        here = [tuple(r) for r in items.where(of_block == block).collect()]  # one block's size
        part = _searched(rows, here, ["__row"], text, window).where(F.size("hit_spans") > 0).select("__row", "hit_spans", "hit_items")
        part = checkpointed(part)
        hits = part if hits is None else hits.unionByName(part)
    each = hits.groupBy("__row").agg(F.flatten(F.collect_list("hit_spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"))

    def setup():
        return lambda spans: [pa.array([[{"start": s, "end": e} for s, e in merged([(x["start"], x["end"]) for x in own])] for own in spans.to_pylist()], SPANS_ARROW)]

    each = checkpointed(arrow_map(each, ["spans"], ["__row", "hit_items"], FOUND[1:2], setup))
    counted = arrow_map(rows, [text], [*keep, "__row"], FOUND[:1], lambda: lambda texts: [pa.array([len(split_words(t)) for t in texts.to_pylist()], pa.int64())])
    joined = counted.join(each, "__row", "left")
    empty = [F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name) for f in FOUND[1:]]
    return joined.select(*keep, "n_words", *empty)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns `keep` of docs with n_words, hit_spans (word ranges), hit_items, n_hit, n_items and contaminated."""
    items = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[item_text].alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    of_block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    if blocks > 1:
        found = _block_after_block(docs, items, blocks, of_block, keep, text, window)
    else:
        found = _searched(docs, [tuple(r) for r in items.collect()], keep, text, window)
    n_hit = F.expr("aggregate(hit_spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        *keep, "n_words", "hit_spans", "hit_items", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items")
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (
  SELECT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT m FROM p),
x AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM d, lengths, unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m),
occ AS (SELECT x.doc_id, x.i, x.m, p.item_id FROM x JOIN p ON x.win = p.win AND x.m = p.m),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM occ, unnest(range(i, i + m)) AS t(j) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
