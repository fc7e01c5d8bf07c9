"""Services as a data source, with made-up transports that write down each call in a folder."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from citeloom.operators import backfill as B
from citeloom.sources import bibliographic as D
from citeloom.sources import services as Sv


def noted(folder, answer, failures=0):
    """A transport whose calls are files of the folder; the first tries of a path fail."""
    os.makedirs(folder, exist_ok=True)
    log = str(folder)

    def make():
        def get(path, params):
            name = json.dumps([path, params], sort_keys=True)
            with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
                out.write(name)
            if sum(open(f"{log}/{f}").read() == name for f in os.listdir(log)) <= failures:
                raise OSError("busy")
            return answer(path, params)

        return get

    return make


def calls(folder):
    return [json.loads(x) for x in sorted(open(f"{folder}/{f}").read() for f in os.listdir(folder))]


def records(path, params):
    return {i: {"title": f"T {i}"} for i in params["ids"] if not i.endswith("7")}


@pytest.mark.parametrize("service, size", [("semantic_scholar", 500), ("openalex", 50), ("europe_pmc", 20)])
def test_batches(spark, tmp_path, service, size):
    """Lookups go in the service's batches, and each id is asked for once; what has no record is null."""
    D.register(spark, noted(tmp_path / "log", records))
    n = 2 * size + 3
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"))
    ids.repartition(1).write.parquet(f"{tmp_path}/ids")
    found = spark.read.format(D.NAME).options(service=service, call="lookup", ids=f"{tmp_path}/ids", answers=f"{tmp_path}/answers").load()
    rows = found.collect()
    assert sorted(int(r.id) for r in rows) == list(range(n)) and all((r.record is None) == r.id.endswith("7") and r.tries == 1 for r in rows)
    asked = calls(tmp_path / "log")
    assert sorted(len(p["ids"]) for _, p in asked) == [3, size, size]
    # evaluated again, nothing is asked again
    assert found.count() == n and len(calls(tmp_path / "log")) == 3


def test_pushed_ids_and_retries(spark, tmp_path):
    """Ids come by a filter that is pushed down; failures are tried again and counted."""
    D.register(spark, noted(tmp_path / "log", lambda path, params: {"data": [{"paperId": f"{path}-{k}"} for k in range(3)]}, failures=1))
    found = spark.read.format(D.NAME).options(service="semantic_scholar", call="search", limit=2).load()
    # sorted here: to sort in Spark would ask once more, for ranges, as no answers are kept
    rows = sorted(found.where(F.col("id").isin("a b", "c") & (F.col("ord") < 5)).collect())
    assert [(r.id, r.ord, json.loads(r.record)["paperId"], r.tries) for r in rows] == [(i, k, f"/paper/search-{k}", 2) for i in ("a b", "c") for k in (0, 1)]
    assert [p["query"] for _, p in calls(tmp_path / "log")] == ["a b", "a b", "c", "c"]
    again = lambda: spark.read.format(D.NAME).options(service="semantic_scholar", call="search", limit=2).load()
    assert len(again().where("id = 'x'").collect()) == 2 and again().where("id = 'x' and id = 'y'").collect() == []
    with pytest.raises(Exception, match="ask for ids"):
        again().collect()


def test_partitions_share_ids(spark, tmp_path):
    D.register(spark, noted(tmp_path / "log", lambda path, params: {"message": {"title": [path]}}))
    found = spark.read.format(D.NAME).options(service="crossref", call="paper", partitions=3).load().where(F.col("id").isin(*[f"d{k}" for k in range(7)]))
    assert found.rdd.getNumPartitions() == 3 and sorted(r.id for r in found.collect()) == [f"d{k}" for k in range(7)]
    assert len(calls(tmp_path / "log")) <= 14  # the plan and its partitions are made apart


def test_torn_answers(tmp_path):
    asked = []
    get = D.cached(lambda path, params: asked.append(path) or {"n": len(asked)}, str(tmp_path / "a"))
    assert get("/x", {}) == get("/x", {}) == {"n": 1}
    (file,) = (tmp_path / "a").iterdir()
    file.write_text("{torn")
    assert get("/x", {}) == {"n": 2} == get("/x", {}) and len(asked) == 2


def test_phases_ask_once(spark, tmp_path):
    """Three phases over forty papers: each phase is asked once for what is left, though its answers are used twice."""
    papers = spark.range(40).select(F.concat(F.lit("p"), "id").alias("paper_id"))
    known = {"one": 10, "two": 25, "three": 40}

    def phase(name):
        make = noted(tmp_path / name, lambda path, params, name=name: {i: {"text": f"<b>{name}</b>"} for i in params["ids"] if int(i[1:]) < known[name]})

        def run(left):
            got = Sv.looked_up(left, "paper_id", "semantic_scholar", make)
            return got.select(F.col("id").alias("paper_id"), F.get_json_object("record", "$.text").alias("abstract"))

        return name, run

    none = spark.createDataFrame([("two:p30",)], "key string")
    found = B.in_phases(papers, none, [phase(n) for n in known]).collect()
    assert {s: sum(r.source == s for r in found) for s in known} == {"one": 10, "two": 15, "three": 15} and {r.abstract for r in found} == {"one", "two", "three"}
    asked = {n: [i for _, p in calls(tmp_path / n) for i in p["ids"]] for n in known}
    assert {n: (len(a), len(set(a))) for n, a in asked.items()} == {"one": (40, 40), "two": (29, 29), "three": (15, 15)}


def test_first_answer_asks_once(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("b",), ("a",)], "id string")
    make = noted(tmp_path / "log", lambda path, params: {"data": [{"title": "S"}] if params.get("query") == "a" else [], "results": [{"title": "O"}]})
    found = Sv.first_answer(ids, "id", [("semantic_scholar", "search", Sv.standardize_s2), ("openalex", "search", Sv.standardize_openalex)], make)
    assert sorted((r.id, r.title, r.source) for r in found.collect()) == [("a", "S", "semantic_scholar"), ("b", "O", "openalex")]
    assert sorted(p.get("query") or p["search"] for _, p in calls(tmp_path / "log")) == ["a", "b", "b"]
