"""Small control files: settings, seeds and clusters in YAML, and an empty warehouse folder."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files that a warehouse folder begins with.
LOGS = ("papers.jsonl", "citations.jsonl", "abstracts.jsonl", "discovered_papers.jsonl", "classifications_7cat.jsonl", "id_map.jsonl", "id_aliases.jsonl", "expansion_state.jsonl")
DEFAULTS = {"storage": {"data": "data", "cache": "cache"}, "calls_a_minute": {"semantic_scholar": 15, "openalex": 60, "crossref": 50}, "confidence": 0.7}


def _yaml():
    try:
        import yaml
    except ImportError as e:  # optional
        raise RuntimeError("YAML files need the yaml package") from e
    return yaml


def read_settings(path: str) -> dict:
    """Settings of a file over the defaults, group by group; a missing file has none."""
    where = Path(path)
    own = (_yaml().safe_load(where.read_text(encoding="utf-8")) or {}) if where.exists() else {}
    if not isinstance(own, dict):
        raise ValueError(f"{path} holds no settings")
    return {k: {**v, **(own.get(k) or {})} if isinstance(v, dict) else own.get(k, v) for k, v in DEFAULTS.items()} | {k: v for k, v in own.items() if k not in DEFAULTS}


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """(query, tag, ord) of a seeds file; seeds without a query are left out."""
    found = (_yaml().safe_load(Path(path).read_text(encoding="utf-8")) or {}).get("seeds") or []
    rows = [(str(s["query"]), s.get("tag"), k) for k, s in enumerate(found) if s.get("query")]
    return spark.createDataFrame(rows, "query string, tag string, ord long")


def clusters_of(summary: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster_id, size, top_venues, top_keywords, nodes): summaries of communities with their members in order."""
    key = ["component", "community"]
    nodes = members.groupBy(*key).agg(F.array_sort(F.collect_list("node")).alias("nodes"))  # a file lists them all
    named = summary.join(nodes, key).withColumn("cluster_id", F.concat(F.lit("c"), F.col("component").cast("string"), F.lit("_"), F.col("community").cast("string")))
    empty = F.array().cast("array<string>")
    return named.select("cluster_id", "size", *[F.coalesce(c, empty).alias(c) for c in ("top_venues", "top_keywords")], "nodes").orderBy("cluster_id")


def write_clusters(clusters: DataFrame, yaml_path: str, notes_path: str) -> int:
    """Clusters as YAML and a line each as notes, one after the other."""
    yaml, n = _yaml(), 0
    with Path(yaml_path).open("w", encoding="utf-8") as out, Path(notes_path).open("w", encoding="utf-8") as notes:
        out.write("clusters:\n")
        for n, r in enumerate(clusters.toLocalIterator(), 1):
            out.write(yaml.safe_dump([{**r.asDict(), "nodes": list(map(str, r["nodes"]))}], sort_keys=False))
            notes.write(f"{r['cluster_id']}: {r['size']} papers; venues {', '.join(r['top_venues']) or 'none'}; words {', '.join(r['top_keywords']) or 'none'}\n")
    return n


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, cluster_id) of a clusters file; of a paper in several the first counts."""
    found = (_yaml().safe_load(Path(path).read_text(encoding="utf-8")) or {}).get("clusters") or [] if Path(path).exists() else []
    rows = [(str(p), c["cluster_id"], k) for k, c in enumerate(found) for p in c.get("nodes") or []]
    return spark.createDataFrame(rows, "paper_id string, cluster_id string, k long").groupBy("paper_id").agg(F.min_by("cluster_id", "k").alias("cluster_id"))


def scaffold(folder: str, seeds: list[dict] | None = None) -> list[str]:
    """An empty warehouse: folders, logs, settings and seeds. What is there stays; returns what was made."""
    where, made = Path(folder), []
    for name in ("", "cache", "network", "graph", "notes"):
        (where / name).mkdir(parents=True, exist_ok=True)
    files = dict.fromkeys(LOGS, "") | {"settings.yaml": json.dumps(DEFAULTS, indent=2), "seeds.yaml": json.dumps({"seeds": seeds or []}, indent=2)}
    for name, body in files.items():
        if not (where / name).exists():
            (where / name).write_text(body, encoding="utf-8")
            made.append(name)
    return made
