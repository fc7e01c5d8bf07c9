"""Queries and SQL of the corpus operators, for the entry module."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language, mixing, near_dedup, neighbours, phrases, quality, secrets, suffix_dedup, token_counts, toxicity, url_filter, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_url_filter": url_filter.op3_url_filter,
        "op4_near_duplicates": near_dedup.op4_near_duplicates,
        "op5_secret_scan": secrets.op5_secret_scan,
        "op6_nearest": neighbours.op6_nearest,
        "op7_token_counts": token_counts.op7_token_counts,
        "op8_quality": quality.op8_quality,
        "op9_language": language.op9_language,
        "op10_mix_sources": mixing.op10_mix_sources,
        "op11_collocations": phrases.op11_collocations,
        "op12_toxicity": toxicity.op12_toxicity,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the whole result. The vocabulary of op7 is part of its SQL, so that needs the file."""
    found = {"op1_decontaminate": decontaminate.OP1_SQL, "op2_suffix_dedup": suffix_dedup.OP2_SQL, "op3_url_filter": url_filter.OP3_SQL, "op5_secret_scan": secrets.OP5_SQL, "op10_mix_sources": mixing.OP10_SQL, "op11_collocations": phrases.OP11_SQL}
    if Path(token_counts.VOCABULARY).exists():
        found["op7_token_counts"] = token_counts.oracle_sql()
    return found
