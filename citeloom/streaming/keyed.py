"""Log reductions as keyed state: one state row a key in the state store, so a batch costs what it holds, not what came before.

Each key keeps its best row by a rank of columns; a row that isn't better changes nothing, however late it comes, and so
nothing expires and there is no watermark. A query's checkpoint holds the state: a run that is started again goes on from
there. What changed in a batch, and only that, is written as that batch's folder of changes; a batch that is run again
writes the same. The newest change of a key is its row.

The state store has to be one that keeps state outside the heap (`with_state_store`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from citeloom.operators.labels import reduced_labels

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LABELS = ["category", "tier", "confidence", "classified_at", "is_core", "ord"]
#: What makes one label row better than another: its tier, then its time, then its place in the log.
LABEL_RANK = {"__tier": "coalesce(cast(tier as int), -1)", "__time": "coalesce(cast(classified_at as string), '')", "__place": "-cast(ord as long)"}


def with_state_store(spark: SparkSession) -> SparkSession:
    """Sets the state store that queries of this module need, for queries that start from here on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


class KeepBest(StatefulProcessor):
    """One row a key: that of the largest rank. It is given out when it changes."""

    def __init__(self, schema: T.StructType, rank: list[str]) -> None:
        self.schema, self.rank = schema, [schema.names.index(c) for c in rank]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[T.Row]:
        held = self.kept.get()
        best = held
        for row in rows:
            if best is None or self._better(row, best):
                best = row
        if best is not held:
            self.kept.update(tuple(best))
            yield T.Row(**dict(zip(self.schema.names, best, strict=True)))

    def _better(self, a, b) -> bool:
        return tuple(a[k] for k in self.rank) > tuple(b[k] for k in self.rank)

    def close(self) -> None:
        pass


class Once(StatefulProcessor):
    """Gives out the first row of a key and no other; keys of the initial state were given out before."""

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "done boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.done.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[T.Row]:
        first = next(iter(rows), None)
        for _ in rows:
            pass
        if first is not None and not self.done.exists():
            self.done.update((True,))
            yield T.Row(**dict(zip(self.names, first, strict=True)))

    def close(self) -> None:
        pass


#: Best rows that a task holds before it gives them out.
HELD_ROWS = 200_000


def combined(rows: DataFrame, key: str, rank: list[str]) -> DataFrame:
    """The best row of each key among the rows of a task, so that keys of many rows are few before they are shuffled.

    A task holds HELD_ROWS best rows at most, and what came since; beyond that it gives them out and begins anew.
    """

    def best(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        order = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in rank]))
        places = pa.table({"key": order[key], "at": pa.array(range(len(order)), pa.int64())})
        last = places.group_by("key", use_threads=False).aggregate([("at", "max")])["at_max"]
        return order.take(last).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, few, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= max(50_000, 2 * few):
                held = [best(held)]
                few = size = held[0].num_rows
                if few >= HELD_ROWS:
                    yield held[0]
                    held, few, size = [], 0, 0
        if held:
            yield best(held)

    return rows.mapInArrow(run, rows.schema)


def best_rows(stream: DataFrame, key: str, rank: dict[str, str]) -> DataFrame:
    """A stream of changes: the rows of `stream` with the rank columns (name -> SQL), one when a key's best row changes.

    Rows with a null key are left out. The rank's columns mustn't be null, and no two rows of a key may have one rank, or the
    one that is met first stays.
    """
    rows = stream.where(F.col(key).isNotNull()).withColumns({c: F.expr(sql) for c, sql in rank.items()})
    # once where they are read, for keys of very many rows, and once where a key's rows meet: each row costs calls into the state
    few = combined(combined(rows, key, list(rank)).repartition(key), key, list(rank))
    processor = KeepBest(rows.schema, list(rank))
    return few.groupBy(key).transformWithState(statefulProcessor=processor, outputStructType=rows.schema, outputMode="Update", timeMode="None")


def new_keys(stream: DataFrame, key: str, done: DataFrame | None = None) -> DataFrame:
    """A stream of the first row of each key that neither came before nor is in `done` (key), which is read once, at the start."""
    with_state_store(stream.sparkSession)
    rows = stream.where(F.col(key).isNotNull())
    initial = None if done is None else done.where(F.col(key).isNotNull()).select(key).distinct().groupBy(key)
    return rows.groupBy(key).transformWithState(statefulProcessor=Once(rows.columns), outputStructType=rows.schema, outputMode="Update", timeMode="None", initialState=initial)


def label_changes(log: DataFrame) -> DataFrame:
    """Changes of the winning label row of each paper. A late row of a higher tier still wins."""
    return best_rows(log.select("paper_id", *LABELS), "paper_id", LABEL_RANK)


def first_changes(log: DataFrame, key: str = "paper_id", order: str = "ord") -> DataFrame:
    """Changes of the first row of each key, that of the least `order`, also if it comes in a later batch."""
    return best_rows(log, key, {"__place": f"-cast({order} as long)"})


def kept(changes: DataFrame, folder: str, checkpoint: str, *, available_now: bool = True):
    """Runs a stream of changes into a folder, from where the checkpoint says. Returns the running query."""
    with_state_store(changes.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current(spark: SparkSession, folder: str, key: str = "paper_id") -> DataFrame:
    """The newest change of each key."""
    rows = spark.read.option("basePath", folder).parquet(folder)
    names = [c for c in rows.columns if not c.startswith("__") and c not in ("batch", key)]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("x")).select(key, "x.*")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return reduced_labels(current(spark, folder))
