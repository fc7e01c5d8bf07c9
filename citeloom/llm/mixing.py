"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in a fixed pseudo-random order, are cut into blocks of `block_size` units (here bytes of text).
Let the sources that still have blocks get their weights' shares of every slot without a break: block j of a source of
weight w is then worked on in virtual time from j/w to (j+1)/w. A virtual time V is the real time N + V*W, with W the weights
of the sources that last beyond V and N the blocks of those that don't. Block j is released in the slot in which its work
begins, and due when it ends. In every slot the released block with the earliest deadline goes next. As the ideal shares are
a schedule in parts that keeps all releases and deadlines, earliest deadline first keeps them too, and at any time a source is
less than one block from its share, also after others ran out. Weights are whole numbers, of any sum, and nothing is rounded.

The driver sees one row a source and schedules blocks, `MOST_BLOCKS` and one a source at most: where blocks of `BLOCK_BYTES`
would be more, they are larger. The plan that is broadcast, three numbers a block, is bounded by that, for any corpus.

The place of a document in its source needs no sort of a whole source: documents are dealt by source and hash range, sums
of the ranges give the offsets, and each range is ordered by itself, so a source with a third of all rows is spread.

Defined cases: null is a source of its own; null and empty texts have size 0 and stay in the mix; a document longer than a
block takes as many blocks; repeated rows are mixed one by one, in any order among themselves, and so are rows without a
doc_id; a weight for a source without documents is ignored, a source without a weight counts as 1, and weights that aren't
whole numbers of 1 or more raise an error, as do more than MOST_SOURCES sources; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from fractions import Fraction
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import table

BLOCK_BYTES = 64 << 10
#: Blocks of the schedule, but for one more a source, at most.
MOST_BLOCKS = 1 << 20
#: Documents of one hash range of a source.
RANGE_ROWS = 2_000
#: Rows that the driver gets, one a source.
MOST_SOURCES = 1 << 20


def windows_of(blocks: list[int], weights: list[int]) -> list[tuple[list[int], list[int]]]:
    """Releases and deadlines of every source's blocks."""
    ends = sorted((Fraction(n, w), n, w) for n, w in zip(blocks, weights, strict=True))
    when = [e[0] for e in ends]
    done = [0, *accumulate(e[1] for e in ends)]
    live = [sum(weights), *(sum(weights) - x for x in accumulate(e[2] for e in ends))]
    out = []
    for n, w in zip(blocks, weights, strict=True):
        release, deadline, at = [], [], 0
        for j in range(n + 1):
            # sources that end by the virtual time j/w; real time is continuous there, so either side of an end will do
            at = bisect_right(when, Fraction(j, w), at)
            real, rest = divmod(j * live[at], w)
            if j < n:
                release.append(done[at] + real)
            if j:
                deadline.append(done[at] + real + (rest > 0))
        out.append((release, deadline))
    return out


def schedule(blocks: list[int], weights: list[int]) -> list[tuple[list[int], list[int], list[int]]]:
    """Slots, releases and deadlines of every source's blocks, by earliest deadline among released blocks."""
    windows = windows_of(blocks, weights)
    coming = [(release[0], s) for s, (release, _) in enumerate(windows) if release]
    heapq.heapify(coming)
    ready: list[tuple[int, int]] = []  # deadline, source
    slots: list[list[int]] = [[] for _ in blocks]
    for slot in range(sum(blocks)):
        while coming and coming[0][0] <= slot:
            _, s = heapq.heappop(coming)
            heapq.heappush(ready, (windows[s][1][len(slots[s])], s))
        _, s = heapq.heappop(ready)
        slots[s].append(slot)
        if len(slots[s]) < blocks[s]:
            heapq.heappush(coming, (windows[s][0][len(slots[s])], s))
    return [(own, release, deadline) for own, (release, deadline) in zip(slots, windows, strict=True)]


def mix(
    docs: DataFrame,
    *,
    keep: list[str],
    size: Column,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: dict[str | None, int] | None = None,
    block_size: int = BLOCK_BYTES,
    seed: int = 42,
) -> DataFrame:
    """Columns `keep` with weight, slot, block_no, release, deadline (slots) and block_offset. Read in order of slot, block_offset.

    Without weights a source's weight is the square root of its size, which favours small sources.
    """
    # rows without a doc_id are told apart by their place, so that many of them don't meet in one range
    named = F.coalesce(docs[doc_id].cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    spread = F.md5(F.concat(F.lit(f"{seed}:"), named))
    rows = docs.select(
        *[docs[c] for c in dict.fromkeys([*keep, source, doc_id])],
        F.coalesce(F.concat(F.lit("="), docs[source].cast("string")), F.lit("")).alias("__source"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("__size"),
        spread.alias("__hash"),
    )
    totals = rows.groupBy("__source").agg(F.sum("__size").alias("size"), F.count("*").alias("rows")).orderBy("__source").limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    block_size = max(block_size, sum(r["size"] for r in totals) // MOST_BLOCKS + 1)
    ranges = [(r["__source"], -(-r["rows"] // RANGE_ROWS)) for r in totals]
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame(ranges, "__source string, __ranges long")), "__source")  # a row a source
    first = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long")  # 32 bits: ranges are in the order of the hash
    rows = rows.withColumn("__range", F.shiftright(first * F.col("__ranges"), 32).cast("int"))
    sums = rows.groupBy("__source", "__range").agg(F.sum("__size").alias("__sum"))
    before = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__source", "__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__source", "__range").orderBy("__hash", doc_id, "__size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(offsets, ["__source", "__range"])
    placed = placed.withColumn("__start", F.col("__before") + F.col("__inside"))
    placed = placed.withColumn("block_no", F.expr(f"__start div {int(block_size)}"))
    placed = placed.withColumn("block_offset", F.col("__start") - F.col("block_no") * block_size)

    blocks = [r["size"] // block_size + 1 for r in totals]
    if weights is None:
        whole = [max(1, isqrt(r["size"])) for r in totals]
    else:
        if any(isinstance(v, bool) or int(v) != v or v < 1 for v in weights.values()):
            raise ValueError("weights are whole numbers of 1 or more")
        by_key = {"" if k is None else f"={k}": int(v) for k, v in weights.items()}
        whole = [by_key.get(r["__source"], 1) for r in totals]
    plan = [(r["__source"], w, *windows) for r, w, windows in zip(totals, whole, schedule(blocks, whole), strict=True)]
    places = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("__slots", "__releases", "__deadlines")]
    schema = T.StructType([T.StructField("__source", T.StringType()), T.StructField("weight", T.LongType()), *places])
    found = placed.join(F.broadcast(docs.sparkSession.createDataFrame(plan, schema)), "__source")  # one row a source, three numbers a block
    at = F.col("block_no").cast("int")
    named = [F.get(f"__{c}s", at).alias(c) for c in ("slot", "release", "deadline")]
    return found.select(*keep, "weight", "block_no", "block_offset", *named)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return mix(documents, keep=["doc_id", "source"], size=F.octet_length("text"))


#: Places by sums in the order of the hash, releases and deadlines by the formula, and slots one after the other.
OP10_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('=' || source, '') AS s, coalesce(octet_length(encode(text)), 0) AS z, md5('42:' || doc_id) AS h FROM documents),
p AS (SELECT *, coalesce(sum(z) OVER (PARTITION BY s ORDER BY h, doc_id, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at_byte FROM d),
size AS (SELECT greatest({BLOCK_BYTES}, sum(z)::BIGINT // {MOST_BLOCKS} + 1) AS b FROM d),
src AS (SELECT s, sum(z)::BIGINT // any_value(b) + 1 AS n, greatest(1, floor(sqrt(sum(z)))::BIGINT) AS w, CAST(row_number() OVER (ORDER BY s) AS INT) AS k FROM d, size GROUP BY s),
j AS (SELECT src.*, t.v FROM src, unnest(range(0, n + 1)) AS t(v)),
e AS (SELECT j.k, j.v, any_value(j.n) AS n, any_value(j.w) AS w, sum(CASE WHEN o.n * j.w <= j.v * o.w THEN o.n ELSE 0 END)::BIGINT AS done, sum(CASE WHEN o.n * j.w <= j.v * o.w THEN 0 ELSE o.w END)::BIGINT AS live FROM j, src AS o GROUP BY j.k, j.v),
x AS (SELECT k, v, n, done + v * live // w AS begins, done + (v * live + w - 1) // w AS ends FROM e),
blocks AS (SELECT a.k, a.v, a.begins AS release, b.ends AS deadline FROM x AS a JOIN x AS b ON b.k = a.k AND b.v = a.v + 1 WHERE a.v < a.n),
r AS (SELECT 0::BIGINT AS slot, (SELECT list(0::BIGINT) FROM src) AS taken, NULL::INT AS k, NULL::BIGINT AS v
  UNION ALL SELECT slot + 1, list_transform(range(1, len(any_value(taken)) + 1), lambda i: any_value(taken)[i] + CASE WHEN i = arg_min(blocks.k, deadline * 1000000 + blocks.k) THEN 1 ELSE 0 END), arg_min(blocks.k, deadline * 1000000 + blocks.k), arg_min(blocks.v, deadline * 1000000 + blocks.k)
  FROM r JOIN blocks ON release <= slot AND blocks.v = taken[blocks.k] GROUP BY slot)
SELECT doc_id, source, src.w AS weight, at_byte // b AS block_no, at_byte % b AS block_offset, r.slot - 1 AS slot, release, deadline
FROM p JOIN src USING (s), size, blocks, r WHERE blocks.k = src.k AND blocks.v = at_byte // b AND r.k = src.k AND r.v = blocks.v"""
