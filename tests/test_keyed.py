"""Keyed state of streams: late rows, restarts, hot keys, and what a small batch on many keys writes."""

import json

import pytest
from pyspark.sql import functions as F

from citeloom.streaming import keyed as K
from citeloom.streaming import logs as St

SCHEMA = "paper_id string, category string, tier int, classified_at string, confidence string, is_core boolean, ord long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", width)


def write(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def row(paper, category, tier, at, ord_):
    return {"paper_id": paper, "category": category, "tier": tier, "classified_at": at, "ord": ord_}


def run(spark, tmp_path, changes=K.label_changes, name="labels"):
    stream = St.stream_log(spark, f"{tmp_path}/in", SCHEMA, files_a_batch=1)
    K.kept(changes(stream), f"{tmp_path}/{name}", f"{tmp_path}/{name}-ck").awaitTermination()


def winners(spark, tmp_path):
    return {r.paper_id: r.category for r in K.current(spark, f"{tmp_path}/labels").collect()}


def test_late_rows_and_restarts(spark, tmp_path):
    write(tmp_path / "in", "1.json", row("a", "x", 3, "2020", 0), row("b", "y", 1, "2020", 1), row(None, "n", 9, "2030", 9))
    run(spark, tmp_path)
    assert winners(spark, tmp_path) == {"a": "x", "b": "y"}
    # a new run goes on from the checkpoint: newer rows of a lower tier lose, an old one of a higher tier wins
    write(tmp_path / "in", "2.json", row("a", "z", 1, "2024", 2), row("b", "w", 2, "2010", 3), "{torn")
    run(spark, tmp_path)
    assert winners(spark, tmp_path) == {"a": "x", "b": "w"}
    assert [(r.paper_id, r.category) for r in spark.read.parquet(f"{tmp_path}/labels/batch=1").collect()] == [("b", "w")]
    # of equal tiers and times the first row of the log stays, null tiers count least
    write(tmp_path / "in", "3.json", row("b", "later", 2, "2010", 7), row("c", "none", None, None, 8), row("c", "zero", 0, None, 12))
    run(spark, tmp_path)
    assert winners(spark, tmp_path) == {"a": "x", "b": "w", "c": "zero"}
    assert {r.paper_id: r.category for r in K.labels(spark, f"{tmp_path}/labels").collect()} == winners(spark, tmp_path)


def test_first_rows(spark, tmp_path):
    write(tmp_path / "in", "1.json", row("a", "second", 1, "2020", 5), row("b", "y", 1, "2020", 1))
    write(tmp_path / "in", "2.json", row("a", "first", 1, "2024", 2), row("b", "w", 2, "2010", 3))
    run(spark, tmp_path, K.first_changes, "firsts")
    assert {r.paper_id: r.category for r in K.current(spark, f"{tmp_path}/firsts").collect()} == {"a": "first", "b": "y"}


def test_small_batch_on_many_keys(spark, tmp_path):
    """Ten rows on 20,000 keys change their own keys only, and the batch's state commit has no more rows than that."""
    write(tmp_path / "in", "1.json", *(row(f"p{k}", "x", 1, "2020", k) for k in range(20_000)))
    run(spark, tmp_path)
    write(tmp_path / "in", "2.json", *(row(f"p{k}", "y", 2, "2019", 30_000 + k) for k in range(0, 10_000, 1_000)))
    stream = St.stream_log(spark, f"{tmp_path}/in", SCHEMA, files_a_batch=1)
    query = K.kept(K.label_changes(stream), f"{tmp_path}/labels", f"{tmp_path}/labels-ck")
    query.awaitTermination()
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 20_000 and state["numRowsUpdated"] == 10
    assert spark.read.parquet(f"{tmp_path}/labels/batch=1").count() == 10
    assert K.current(spark, f"{tmp_path}/labels").groupBy("category").count().collect() is not None
    assert {(r.category, r["count"]) for r in K.current(spark, f"{tmp_path}/labels").groupBy("category").count().collect()} == {("x", 19_990), ("y", 10)}


def test_hot_key_is_few_rows_before_the_shuffle(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("__place")).coalesce(1)
    few = K.combined(rows, "k", ["__place"]).where("k = 'hot'")
    assert few.count() <= 50_000 / 10_000 + 1 and few.agg(F.max("__place")).first()[0] == 49_999


def test_keys_of_many_rows_are_few_rows_before_the_shuffle(spark):
    """A task gives out one row a key, however many batches its rows come in; large numbers and nulls stay as they are."""
    rows = spark.range(60_000).select((F.col("id") % 700).alias("k"), (F.col("id") * 1009 % 60_000).alias("__place"), F.when(F.col("id") % 2 == 0, F.col("id") + 2**60).alias("big")).coalesce(1)
    few = K.combined(rows, "k", ["__place"]).collect()
    want = rows.groupBy("k").agg(F.max_by(F.struct("__place", "big"), "__place").alias("x")).select("k", "x.*").collect()
    assert len(few) == 700 and {tuple(r) for r in few} == {tuple(r) for r in want}


def test_task_holds_few_rows(spark, monkeypatch):
    """Beyond its limit a task gives out what it holds; the best rows of all keys are still there."""
    rows = spark.range(130_000).select((F.col("id") % 40_000).alias("k"), F.col("id").alias("__place")).coalesce(1)
    monkeypatch.setattr(K, "HELD_ROWS", 30_000)
    found = K.combined(rows, "k", ["__place"]).groupBy("k").agg(F.max("__place").alias("p"))
    assert found.where("p < 90000").count() == 0 and found.count() == 40_000


def test_state_grows_with_the_log(spark, tmp_path, monkeypatch):
    """A large log has more state partitions, and each part of it is one batch, written by as many tasks as read it."""
    from citeloom.plans import label_queries as Q

    spark.conf.set("spark.sql.shuffle.partitions", 9)
    events = spark.range(60).selectExpr("id as event_id", "timestamp '2024-01-01' as ts", "id % 7 as user_id", "'view' as event_type", "cast(id as double) as value")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(Q, "ROWS_A_STATE", 10)
    place = tmp_path / "work"
    monkeypatch.setattr(Q, "scratch", lambda *a: str(place))
    assert Q.incremental_labels(spark, str(tmp_path)).count() == 7
    assert len(list((place / "checkpoint" / "state" / "0").glob("[0-9]*"))) == 6
    assert len(list((place / "changes").glob("batch=*"))) == 3 and len(list((place / "log").glob("*.parquet"))) > 3
