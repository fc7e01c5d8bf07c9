"""Titles of two whole tables that match: equal ones, and one of more than 20 characters within a longer one.

Different titles are compared, not rows. For containment a title is known by grams of `GRAM` characters: of every `WINDOW`
grams in a row the one with the smallest hash. A title of 21 characters has such a window, and what lies within a longer title
has the same grams there, so the longer one has all grams of the shorter. Each title is therefore looked for by one of its
grams alone, the one that the fewest titles have (a prefix filter of length one, as all grams must be shared): a pair meets
once at most, and never by a common gram if the shorter has a rare one. What meets is compared by the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import cut_lineage

#: Fixed value: of how many characters a title has more that counts within a longer one.
CONTAINED = 20
GRAM = 8
WINDOW = CONTAINED + 1 - GRAM + 1


#: Odd factors of a gram's hash, which is a polynomial of its characters modulo 2 ** 64, mixed once.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _least_hashes(title: str) -> np.ndarray:
    h = np.frombuffer(title.encode("utf-32-le"), np.uint32).astype(np.uint64)
    for k, factor in enumerate(_FACTORS):  # of 2, 4 and GRAM characters
        h = h[: -(1 << k)] * np.uint64(factor) + h[1 << k :]
    h = ((h ^ h >> np.uint64(31)) * np.uint64(_FACTORS[0])).view(np.int64)
    width = 1
    while width < WINDOW:  # least of 2, 4, 8 and WINDOW hashes in a row
        step = min(width, WINDOW - width)
        h = np.minimum(h[:-step], h[step:])
        width += step
    return np.unique(h)


@F.arrow_udf(T.ArrayType(T.LongType()))
def grams(keys: pa.Array) -> pa.Array:
    """The hashes that stand for a title: the least of every window; none for titles of up to CONTAINED characters."""
    return pa.array([_least_hashes(k) if k is not None and len(k) > CONTAINED else None for k in keys.to_pylist()], pa.list_(pa.int64()))


def matching_titles(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """(left, right, n_left, n_right): every pair of normalised titles that match, each once, and how many rows have them.

    Empty and null titles match nothing. Titles of one table alone aren't compared with each other.
    """
    sides = left.select(F.col(key).alias("key"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(F.col(key).alias("key"), F.lit(0).alias("l"), F.lit(1).alias("r")))
    keys = sides.where("key <> ''").groupBy("key").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    keys = cut_lineage(keys.withColumn("id", F.monotonically_increasing_id()))
    on_left, on_right, length = F.col("n_left") > 0, F.col("n_right") > 0, F.length("key")
    most = keys.agg(F.max(F.when(on_left, length)).alias("left"), F.max(F.when(on_right, length)).alias("right")).first()
    sought = (on_left & (length < (most["right"] or 0))) | (on_right & (length < (most["left"] or 0)))
    # titles go by number: a long one has many grams, and its text must not go with each
    numbers = keys.where(length > CONTAINED).select("id", on_left.alias("l"), on_right.alias("r"), sought.alias("sought"), F.explode(grams(F.col("key"))).alias("gram"))
    rows = cut_lineage(numbers)
    often = rows.groupBy("gram").agg(F.count_if("l").alias("often_l"), F.count_if("r").alias("often_r"), F.bool_or("sought").alias("any")).where("any").drop("any")
    others = F.when(F.col("l"), F.col("often_r")).otherwise(0) + F.when(F.col("r"), F.col("often_l")).otherwise(0)
    rarest = rows.where("sought").join(often, "gram").groupBy("id", "l", "r").agg(F.min(F.struct(others.alias("often"), "gram")).alias("x")).where("x.often > 0")
    rarest = rarest.select(F.col("id").alias("short_id"), F.col("l").alias("s_l"), F.col("r").alias("s_r"), F.col("x.gram").alias("gram"))
    met = rarest.join(rows, "gram").where("short_id <> id and (s_l and r or s_r and l)").select("short_id", "id")
    short = keys.where((length > CONTAINED) & sought).select(F.col("id").alias("short_id"), F.col("key").alias("short"), F.col("n_left").alias("s_left"), F.col("n_right").alias("s_right"))
    met = met.join(short, "short_id").join(keys.withColumnRenamed("key", "long"), "id")
    met = met.where((F.length("short") < F.length("long")) & (F.instr(F.col("long"), F.col("short")) > 0))
    one = F.when((F.col("s_left") > 0) & on_right, F.struct(F.col("short").alias("left"), F.col("long").alias("right"), F.col("s_left").alias("n_left"), F.col("n_right").alias("n_right")))
    other = F.when((F.col("s_right") > 0) & on_left, F.struct(F.col("long").alias("left"), F.col("short").alias("right"), F.col("n_left").alias("n_left"), F.col("s_right").alias("n_right")))
    within = met.select(F.explode(F.array_compact(F.array(one, other))).alias("x")).select("x.*")
    equal = keys.where("n_left > 0 and n_right > 0").select(F.col("key").alias("left"), F.col("key").alias("right"), "n_left", "n_right")
    return equal.unionByName(within)


def matched_rows(left: DataFrame, right: DataFrame, pairs: DataFrame, left_id: str, right_id: str, key: str = "key") -> DataFrame:
    """(left_id, right_id) of the rows behind pairs of titles: as many as n_left times n_right, so for pairs that are few."""
    a = left.select(F.col(left_id).alias("left_id"), F.col(key).alias("left"))
    b = right.select(F.col(right_id).alias("right_id"), F.col(key).alias("right"))
    return pairs.join(a, "left").join(b, "right").select("left_id", "right_id")
