"""Label logs: one authoritative label for each paper out of many rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from citeloom.functions import fixed, text

from .graph import cut_lineage


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """(alias, canonical) with chains followed for at most 16 steps; of several rows of an alias the last (`ord`) wins.

    Following a chain 16 times is squaring the map four times; cycles come out as 16 steps leave them.
    """
    known = aliases.where(text.has_text(F.col("alias")) & text.has_text(F.col("canonical")))
    hop = known.groupBy("alias").agg(F.max_by("canonical", "ord").alias("canonical"))
    for _ in range(4):
        after = hop.select(F.col("alias").alias("canonical"), F.col("canonical").alias("further"))
        hop = hop.join(after, "canonical", "left").select("alias", F.coalesce("further", "canonical").alias("canonical"))
    return hop


def canonicalized(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """df with `column` replaced by the canonical id; `aliases` are resolved."""
    names = aliases.select(F.col("alias").alias(column), F.col("canonical").alias("__canonical"))
    return df.join(names, column, "left").withColumn(column, F.coalesce("__canonical", column)).select(*df.columns)


def reduced_labels(log: DataFrame) -> DataFrame:
    """The row with the highest tier, then the latest time, then the first place (`ord`), for each paper_id.

    A missing tier counts as -1 and a missing time as the earliest. All of it is one max_by, combined on the map side.
    """
    rank = F.struct(F.coalesce("tier", F.lit(-1)), F.coalesce(F.col("classified_at").cast("string"), F.lit("")), -F.col("ord"))
    kept = F.struct("category", "tier", "confidence", "classified_at", "is_core")
    best = log.where("paper_id is not null").groupBy("paper_id").agg(F.max_by(kept, rank).alias("x"))
    core = F.coalesce(F.col("x.is_core"), F.lit(False)) | F.coalesce(F.col("x.category").isin(*fixed.CORE_CATEGORIES), F.lit(False))
    return best.select("paper_id", "x.category", "x.tier", "x.confidence", "x.classified_at", core.alias("is_core"))


def last_labels(log: DataFrame, key: str = "paper_id", value: str = "category") -> DataFrame:
    return log.groupBy(key).agg(F.max_by(value, "ord").alias(value))


def first_labels(log: DataFrame, key: str = "paper_id", value: str = "category") -> DataFrame:
    return log.groupBy(key).agg(F.min_by(value, "ord").alias(value))


def layered_labels(legacy: DataFrame, binary: DataFrame, log: DataFrame) -> DataFrame:
    """The network's rule: legacy labels, under binary answers, under the log; the last record of a layer wins.

    A binary yes overrides a legacy label, and a no counts only where there is none.
    """
    named = legacy.where("paper_id is not null and category is not null")
    old = named.groupBy("paper_id").agg(F.max_by(text.legacy_category(F.col("category")), "ord").alias("old"))
    answers = binary.where("paper_id is not null and is_positive is not null")
    # a yes stays whatever follows, because a no never replaces a label
    said = answers.groupBy("paper_id").agg(F.bool_or("is_positive").alias("yes"))
    new = last_labels(log.where("paper_id is not null and category is not null")).withColumnRenamed("category", "new")
    both = old.join(said, "paper_id", "full").join(new, "paper_id", "full")
    binary_label = F.when(F.col("yes"), fixed.CORE_CATEGORIES[0])
    return both.select("paper_id", F.coalesce("new", binary_label, "old", F.when(~F.col("yes"), fixed.EXCLUDED_CATEGORY)).alias("category"))


def any_core(log: DataFrame) -> DataFrame:
    """The expansion's rule: papers with any core row."""
    return log.where(F.col("category").isin(*fixed.CORE_CATEGORIES)).select("paper_id").distinct()


def tier_floor(tier: int | str | None) -> int:
    if tier is None:
        return -1
    if isinstance(tier, int):
        return tier
    name = tier.strip().lower()
    if name not in fixed.TIER_NAMES:
        raise ValueError(f"unknown tier {tier!r}; give 0 to 3 or one of {sorted(fixed.TIER_NAMES)}")
    return fixed.TIER_NAMES[name]


def papers_in_category(
    labels: DataFrame,
    category: str,
    *,
    papers: DataFrame | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    node_types: list[str] | None = None,
    tier_min: int | str | None = None,
    categories: tuple[str, ...] = fixed.ALL_CATEGORIES,
) -> DataFrame:
    """paper_id of the papers with that label. A bound on the year leaves out papers without one."""
    if category not in categories:
        raise ValueError(f"unknown category {category!r}; choose from {sorted(categories)}")
    found = labels.where((F.col("category") == category) & (F.coalesce("tier", F.lit(-1)) >= tier_floor(tier_min)))
    if papers is not None and (year_min is not None or year_max is not None or node_types):
        wanted = F.lit(True)
        if year_min is not None:
            wanted = wanted & (F.col("year") >= year_min)
        if year_max is not None:
            wanted = wanted & (F.col("year") <= year_max)
        if node_types:
            wanted = wanted & F.col("node_type").isin(*node_types)
        found = found.join(papers.where(wanted).select("paper_id"), "paper_id", "left_semi")
    return found.select("paper_id")


def category_counts(labels: DataFrame, papers: DataFrame | None = None, year_min: int | None = None) -> DataFrame:
    named = labels.where(text.has_text(F.col("category")))
    if year_min is not None:
        named = named.join(papers.where(F.col("year") >= year_min).select("paper_id"), "paper_id", "left_semi")
    return named.groupBy("category").agg(F.count("*").alias("n"))


def category_status(labels: DataFrame, batches: DataFrame, categories: tuple[str, ...] = fixed.VALID_CATEGORIES) -> DataFrame:
    """(item, n): papers of every category, also those without, the roll-ups, the total, and the papers still pending."""
    spark = labels.sparkSession
    known = spark.createDataFrame([(c,) for c in categories], "category string")
    counts = known.join(labels.groupBy("category").agg(F.count("*").alias("n")), "category", "left")
    rows = counts.select(F.col("category").alias("item"), F.coalesce("n", F.lit(0)).alias("n"))
    part = F.col("category")
    sums = labels.agg(
        F.count("*").alias("total"),
        F.count_if(part.isin(*fixed.CORE_CATEGORIES)).alias("core"),
        F.count_if(part.isin(*fixed.SECONDARY_CATEGORIES)).alias("secondary"),
        F.count_if(part == fixed.EXCLUDED_CATEGORY).alias("excluded"),
    ).select(F.expr("stack(4, 'total', total, 'core', core, 'secondary', secondary, 'excluded', excluded) as (item, n)"))
    pending = batches.select("paper_id").where("paper_id is not null").distinct().join(labels, "paper_id", "left_anti")
    return rows.unionByName(sums).unionByName(pending.agg(F.count("*").alias("n")).select(F.lit("pending").alias("item"), "n"))


def distribution(log: DataFrame, column: str = "category") -> DataFrame:
    """Raw rows of each value with their share in per cent, unreduced."""
    counts = log.groupBy(column).agg(F.count("*").alias("n"))
    total = log.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("pct"))


def unclassified(candidates: DataFrame, *logs: DataFrame, key: str = "paper_id") -> DataFrame:
    """Candidates that no log has, each once: the first row (`ord`) of a repeated one, any where there is no order."""
    left = candidates
    for log in logs:
        left = left.join(log.select(key), key, "left_anti")
    if "ord" not in left.columns:
        return left.dropDuplicates([key])
    rest = [c for c in left.columns if c != key]
    return left.groupBy(key).agg(F.min_by(F.struct(*rest), "ord").alias("x")).select(key, "x.*").select(*left.columns)


def agreement(sample: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(first, second, n): how two labellers labelled a sample; what is missing is unknown."""
    a = first.select("paper_id", F.col("category").alias("first"))
    b = second.select("paper_id", F.col("category").alias("second"))
    joined = sample.join(a, "paper_id", "left").join(b, "paper_id", "left").na.fill("unknown", ["first", "second"])
    return joined.groupBy("first", "second").agg(F.count("*").alias("n"))


def agreement_rate(confusion: DataFrame) -> DataFrame:
    same = F.sum(F.when(F.col("first") == F.col("second"), F.col("n")).otherwise(0))
    return confusion.agg(
        same.alias("agreement"), (F.sum("n") - same).alias("disagreement"), F.round(F.coalesce(same / F.sum("n"), F.lit(0.0)), 4).alias("agreement_rate")
    )


def normalized_answers(rows: DataFrame) -> DataFrame:
    """Classifier answers as log rows: id or paper_id, categories mapped, and defaults for what is missing."""
    paper = F.coalesce(text.falsy_to_null(F.col("paper_id")), text.falsy_to_null(F.col("id")))
    category = text.category_of_answer(F.col("category"))
    return rows.where(paper.isNotNull()).select(
        paper.alias("paper_id"),
        category.alias("category"),
        category.isin(*fixed.CORE_CATEGORIES).alias("is_core"),
        F.coalesce("confidence", F.lit("medium")).alias("confidence"),
        F.coalesce("reasoning", F.lit("")).alias("reasoning"),
        F.coalesce("model", F.lit("agent-haiku")).alias("model"),
        F.coalesce("tier", F.lit(1)).alias("tier"),
    )


def audit_batches(log: DataFrame, *, sample: int = 100, size: int = 50, seed: int = 0) -> DataFrame:
    """(paper_id, category, batch) of a sample of labelled papers, with the label of their last row. The seed fixes the sample."""
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col("paper_id").cast("string"))), F.col("paper_id")]
    drawn = last_labels(log).select("paper_id", "category").orderBy(*order).limit(sample)
    return numbered_batches(drawn, order, size).select("paper_id", "category", F.col("batch").cast("int").alias("batch"))


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with `place`: consecutive numbers from 0 in an order, by one shuffle, without sorting everything in one task.

    Rows are range-partitioned and sorted within their partition, where they are numbered as they come; partition sizes, one
    row each, give the offsets. Range bounds come from a sample, so the numbered rows are kept: sizes and places must see the
    same ranges.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    kept = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()))
    part, at = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = kept.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return kept.withColumn("__part", part).join(F.broadcast(offsets), "__part").select(*df.columns, (F.col("__before") + at).alias("place"))


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """df with `name`: the sum of `value` over the rows of the same keys that come before, in an order.

    Rows are range-partitioned by keys and order, so the rows of one key, however many, are in several tasks; each sums its
    own, and what the ranges before hold of a key is added: a row for each range that the key is in.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("__part", F.spark_partition_id())
    names = ranged.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0.0
        for batch in batches:
            own = list(zip(*[batch.column(names.index(k)).to_pylist() for k in keys], strict=True))
            before = []
            for key, v in zip(own, batch.column(names.index(value)).to_pylist(), strict=True):
                if key != last:
                    last, total = key, 0.0
                before.append(total)
                total += v or 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.float64())], names=[*names, "__before"])

    kept = cut_lineage(ranged.mapInArrow(run, T.StructType([*ranged.schema.fields, T.StructField("__before", T.DoubleType())])))
    parts = kept.groupBy(*keys, "__part").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    carried = parts.withColumn("__carried", F.sum("__sum").over(earlier)).where("__carried is not null").drop("__sum")
    joined = kept.join(carried, [*keys, "__part"], "left")
    return joined.select(*df.columns, (F.col("__before") + F.coalesce("__carried", F.lit(0.0))).alias(name))


def numbered_batches(df: DataFrame, order: list[Column], size: int, start: int = 0) -> DataFrame:
    """df with batch and place: consecutive numbers in an order. `start` is the number of the first batch, for batches that
    continue others."""
    if size < 1:
        raise ValueError("a batch has one row at least")
    return numbered(df, order).select(*df.columns, (F.expr(f"place div {size}") + start).alias("batch"), "place")
