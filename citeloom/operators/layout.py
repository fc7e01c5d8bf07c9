"""Positions and sizes of papers on maps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.functions import fixed, text

_ANGLE = math.pi * (3 - math.sqrt(5))


def _of_category(category: Column, values: dict[str, float]) -> Column:
    return text.map_values(category, {k: str(v) for k, v in values.items()}, F.lit("0.0")).cast("double")


def timeline(papers: DataFrame, lanes: dict[str, float] = fixed.LANES) -> DataFrame:
    """(paper_id, x, y): by year within the lane of the category, in order of the id, with a little jitter."""
    year = F.coalesce("year", F.lit(2002))
    lane = Window.partitionBy("category", "__year")
    rows = papers.withColumn("__year", year)
    at = F.row_number().over(lane.orderBy("paper_id")) - 1
    count = F.count("*").over(lane)
    center = _of_category(F.col("category"), lanes)
    y = F.when(count == 1, center).otherwise(center - fixed.LANE_HEIGHT / 2 + at / (count - 1) * fixed.LANE_HEIGHT)
    wide, high = fixed.JITTER["timeline"]
    return rows.select("paper_id", (text.year_x(F.col("__year")) + text.jitter(F.col("paper_id"), 0, wide)).alias("x"), (y + text.jitter(F.col("paper_id"), 2, high)).alias("y"))


def atlas(papers: DataFrame, centers: dict[str, tuple[float, float]] = fixed.CONSTELLATIONS) -> DataFrame:
    """(paper_id, x, y): each category a spiral from its most connected paper."""
    at = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("degree"), "paper_id")) - 1
    x0 = _of_category(F.col("category"), {k: v[0] for k, v in centers.items()})
    y0 = _of_category(F.col("category"), {k: v[1] for k, v in centers.items()})
    radius = fixed.SPIRAL_STEP * F.sqrt(at)
    return papers.select("paper_id", (x0 + radius * F.cos(at * _ANGLE)).alias("x"), (y0 + radius * F.sin(at * _ANGLE)).alias("y"))


def impact(papers: DataFrame) -> DataFrame:
    """(paper_id, x, y): year against the logarithm of the citations."""
    count = F.coalesce("citation_count", F.lit(0))
    most = papers.agg(F.log1p(F.max(count)).alias("__most"))
    scale = F.when(F.col("__most") > 0, F.col("__most")).otherwise(1.0)
    rows = papers.crossJoin(F.broadcast(most))  # one row
    wide, high = fixed.JITTER["impact"]
    return rows.select(
        "paper_id",
        (text.year_x(F.coalesce("year", F.lit(2002))) + text.jitter(F.col("paper_id"), 0, wide)).alias("x"),
        (-fixed.IMPACT_HEIGHT / 2 + F.log1p(count) / scale * fixed.IMPACT_HEIGHT + text.jitter(F.col("paper_id"), 2, high)).alias("y"),
    )


def node_sizes(nodes: DataFrame) -> DataFrame:
    """(paper_id, size, web_size) by degree."""
    most = nodes.agg(F.log1p(F.max("degree")).alias("__most"))
    share = F.sqrt(F.log1p("degree") / F.when(F.col("__most") > 0, F.col("__most")).otherwise(1.0))
    return nodes.crossJoin(F.broadcast(most)).select("paper_id", *[(low + more * share).alias(c) for c, (low, more) in fixed.NODE_SIZES.items()])  # one row
