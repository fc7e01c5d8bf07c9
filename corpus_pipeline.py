"""The corpus pipeline: quality, near duplicates, decontamination, secrets, and the mix.

Every stage takes (spark, docs, sf_dir), works on all rows that it is given, and returns the columns of documents; the last
one adds the places in the mix. Between stages the rows are written as Parquet to the shared folder and read again; they go
when the application ends, as the last stage's rows are read by whoever runs the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, mixing, near_dedup, quality, secrets
from citeloom.llm.common import guarded, table
from citeloom.operators.graph import scratch


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    rows, restore = guarded(docs, COLUMNS)
    machine = quality.fitted(rows, table(spark, sf_dir, "labels"))
    return restore(quality.scored(rows, machine, keep=rows.columns).where(F.col("quality_score") >= quality.THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    rows, restore = guarded(docs, COLUMNS)
    return restore(near_dedup.keep_one(rows))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    rows, restore = guarded(docs, COLUMNS)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), keep=rows.columns)
    return restore(found.where(~F.col("contaminated")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    rows, restore = guarded(docs, COLUMNS)
    return restore(secrets.redact(rows))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents get their places in the mix: read them in order of slot and block_offset."""
    rows, restore = guarded(docs, COLUMNS)
    return restore(mixing.mix(rows, keep=rows.columns, size=F.octet_length("text")), "slot", "block_no", "block_offset")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

#: Trained, sampled and scheduled stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}-{name}")
        docs = spark.read.parquet(f"{place}/{number}-{name}")
    return docs
