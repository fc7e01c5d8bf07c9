"""Graph operators over edge tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of numbers or short names in a broadcast, at most.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir or of setCheckpointDir(). A local one is made only where all runs in one process;
    on a cluster, where executors don't share it, a session without one is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    return kept.get().rstrip("/")


def _path(spark: SparkSession, name: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, name: str) -> bool:
    where, files = _path(spark, name)
    return files.exists(where)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared folder, which goes with all that was written there when the application ends."""
    made = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where, files = _path(spark, made)
    files.mkdirs(where)  # only what is there can be marked
    files.deleteOnExit(where)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder as a table and read again.

    Lineage is cut and executors may be lost; unlike a checkpoint, the table has its own size, not an estimate that
    multiplies with every join of a loop. The table goes when the application ends, or with drop_kept().
    """
    spark = df.sparkSession
    name = scratch(spark, "kept")
    df.write.mode("append").parquet(name)
    kept = spark.read.schema(df.schema).parquet(name)
    kept._kept_in = name
    return kept


def drop_kept(df: DataFrame | None) -> None:
    """Deletes a table of cut_lineage() that nothing will read again."""
    if name := getattr(df, "_kept_in", None):
        where, files = _path(df.sparkSession, name)
        files.delete(where, True)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side of a join that no session broadcasts. Spark goes by the sizes of written tables, whose columns are compressed:
    what is below its limit of 10 MB there can be hundreds of MB in the driver."""
    return df.hint("merge")


def named_ids(ends: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    """(node, id) of all ends (a, b), and how a column's ids are made: by a hash that is different for all of these nodes."""
    nodes = cut_lineage(ends.select("a").union(ends.select("b")).distinct().withColumnRenamed("a", "node"))
    for seed in range(42, 52):
        name = lambda c, seed=seed: F.xxhash64(F.lit(seed), c)
        ids = nodes.select("node", name("node").alias("id"))
        if ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return ids, name
    raise RuntimeError("nodes of equal hashes under all seeds")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node that each node of an edge is connected with; see component_roots()."""
    placed = cut_lineage(component_roots(edges, src, dst, max_rounds))
    return placed.join(placed.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")


def component_roots(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, root): a number of the component of each node of an edge. Without names it is enough to tell components apart.

    Contraction: each node goes to the least of itself and its neighbours, and edges are drawn anew between those that nodes
    went to, so every round has fewer nodes and edges. Nodes are hashes of their names: their order is a random one, in which
    a long path has short descents only. The rounds are then read backwards, from the smallest on. No neighbour list is ever
    gathered; each round is written. Null endpoints are ignored; a self-loop makes its node a component; directions and
    repeats don't matter.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    ids, name = named_ids(ends)
    links, steps = ends.select(name("a").alias("a"), name("b").alias("b")).where("a <> b"), []
    links = cut_lineage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        edges_left = links.count()
        if not edges_left:
            break
        side = by_shuffle if edges_left > BROADCAST_ROWS else lambda df: df
        both = links.union(links.select("b", "a"))
        step = cut_lineage(both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("id"), F.least("a", "to").alias("to")))
        moved = links
        for end in ("a", "b"):
            moved = moved.join(side(step.withColumnsRenamed({"id": end, "to": "__to"})), end).withColumn(end, F.col("__to")).drop("__to")
        moved = moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        old, links = links, cut_lineage(moved)
        drop_kept(old)
        steps.append((step, side))
    else:
        raise RuntimeError("components did not settle")
    root = None
    for step, side in reversed(steps):
        if root is not None:
            after = side(root.withColumnsRenamed({"id": "to", "root": "__root"}))
            step = step.join(after, "to", "left").select("id", F.coalesce("__root", "to").alias("to"))
        root = step.withColumnRenamed("to", "root")
    if root is None:
        return ids.select("node", F.col("id").alias("root"))
    return ids.join(side(root), "id", "left").select("node", F.coalesce("root", "id").alias("root"))
