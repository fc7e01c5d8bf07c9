"""Shared pieces of the corpus operators: tables, checkpoints, words, and Arrow mapping with bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.operators.graph import cut_lineage

#: Rows of one Arrow batch are handed on in slices of about this many bytes, so that Python objects stay bounded.
SLICE_BYTES = 4 << 20

#: Keys that a spread join broadcasts, at most.
HOT_KEYS = 1024

#: Lower-cases A-Z and turns every other ASCII byte that isn't a digit or a-z into a space; bytes of other characters stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: str | bytes | None) -> list[bytes]:
    """Words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as UTF-8; null has none."""
    if not text:
        return []
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    return text.translate(WORD_BYTES).split()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder: lineage is cut, and executors may be lost."""
    return cut_lineage(df)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread_join(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """rows left-joined with lookup, which has one row a key at most.

    A key of one part in HOT_KEYS of all rows or more is joined by a broadcast, whether the lookup has it or not, and there are
    HOT_KEYS of them at most; rows without a key are not joined at all; the others are joined by a shuffle. So no task gets all
    rows of a key, and what is broadcast has a bound.
    """
    total = rows.count()
    often = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") * HOT_KEYS >= total).select(key)
    hot = checkpointed(often.join(lookup, key, "left"))
    near = rows.join(F.broadcast(hot), key)
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields if f.name != key]
    without = rows.where(F.col(key).isNull()).select(key, *[c for c in rows.columns if c != key], *added)
    rest = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti").join(lookup, key, "left")
    return near.unionByName(rest).unionByName(without)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    rows = batch.num_rows
    step = max(1, int(rows * most / max(most, batch.nbytes)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def arrow_map(
    df: DataFrame, inputs: list[str], keep: list[str], fields: list[T.StructField], setup: Callable[[], Callable]
) -> DataFrame:
    """Columns `keep` of df and new `fields`. setup() runs once a task; what it returns maps columns to new columns.

    Extra columns of df are neither read nor returned, so their names can't clash.
    """
    names = list(dict.fromkeys([*keep, *inputs]))
    source = df.select(*[df[c] for c in names])
    schema = T.StructType([source.schema[c] for c in keep] + fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = setup()
        for whole in batches:
            for batch in slices(whole):
                new = make(*[batch.column(names.index(c)) for c in inputs])
                kept = [batch.column(names.index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)


def guarded(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """docs with the columns but `names` renamed, so that no operator's column clashes, and what names them again.

    Further columns given to the second are returned too, under their own names or, where taken, with underscores added.
    """
    safe = [c if c in names else f"__extra_{k}" for k, c in enumerate(docs.columns)]

    def restore(df: DataFrame, *more: str) -> DataFrame:
        taken, extra = set(docs.columns), []
        for c in more:
            name = c
            while name in taken:
                name += "_"
            taken.add(name)
            extra.append(df[c].alias(name))
        return df.select(*[df[s].alias(c) for s, c in zip(safe, docs.columns, strict=True)], *extra)

    return docs.toDF(*safe), restore
