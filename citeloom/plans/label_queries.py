"""Label-log queries. `events` is the log: user_id a paper, event_type its category, ts the time, event_id the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators import labels as L
from citeloom.operators.graph import scratch
from citeloom.sources import records
from citeloom.streaming import keyed, logs

from .registry import query, table

TYPES = ("click", "error", "purchase", "signup", "view")
#: Rows of a log for which its state has one more partition.
ROWS_A_STATE = 250_000
_LEGACY = {"click": "brain_connectivity", "error": "tda_brain", "purchase": "fmri_gnn", "signup": "graph_no_brain", "view": "spectral_brain"}


def label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("paper_id"),
        F.col("event_type").alias("category"),
        F.pmod(F.col("value").cast("int"), F.lit(4)).alias("tier"),
        F.col("ts").alias("classified_at"),
        F.lit("medium").alias("confidence"),
        F.lit(None).cast("boolean").alias("is_core"),
        F.col("event_id").alias("ord"),
    )


def paper_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as papers, with the year of their first order and their market segment as node type."""
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("paper_id")).agg(F.year(F.min("o_orderdate")).alias("year"))
    kinds = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.col("c_mktsegment").alias("node_type"))
    return kinds.join(first, "paper_id", "left")


_REDUCED = """
reduced AS (SELECT user_id AS paper_id, event_type AS category, tier FROM (
  SELECT *, CAST(trunc(value) AS INT) % 4 AS tier, row_number() OVER (PARTITION BY user_id ORDER BY CAST(trunc(value) AS INT) % 4 DESC, ts DESC, event_id) AS r
  FROM events) WHERE r = 1)"""
_YEARS = """
years AS (SELECT c_custkey AS paper_id, c_mktsegment AS node_type, y AS year FROM customer
  LEFT JOIN (SELECT o_custkey, year(min(o_orderdate)) AS y FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


@query(f"WITH {_REDUCED} SELECT paper_id, category, CAST(tier AS INT) AS tier FROM reduced")
def label_reduce(spark, sf_dir):
    return L.reduced_labels(label_log(spark, sf_dir)).select("paper_id", "category", "tier")


@query("SELECT user_id AS paper_id, arg_max(event_type, event_id) AS category FROM events GROUP BY 1")
def label_last_wins(spark, sf_dir):
    return L.last_labels(label_log(spark, sf_dir))


@query("SELECT user_id AS paper_id, arg_min(event_type, event_id) AS category FROM events GROUP BY 1")
def label_first_wins(spark, sf_dir):
    return L.first_labels(label_log(spark, sf_dir))


@query("""
WITH old AS (SELECT user_id AS paper_id, arg_max(CASE event_type WHEN 'purchase' THEN 'fmri_gnn' WHEN 'click' THEN 'fmri_no_graph' WHEN 'view' THEN 'fmri_graph_classical'
    WHEN 'error' THEN 'fmri_geometric_manifold' WHEN 'signup' THEN 'graph_methods_no_fmri' ELSE 'out_of_scope' END, event_id) AS c FROM events WHERE event_id % 3 = 0 GROUP BY 1),
bin AS (SELECT user_id AS paper_id, bool_or(value > 250) AS yes FROM events WHERE event_id % 3 = 1 GROUP BY 1),
new AS (SELECT user_id AS paper_id, arg_max(event_type, event_id) AS c FROM events WHERE event_id % 3 = 2 AND value > 450 GROUP BY 1)
SELECT paper_id, coalesce(new.c, CASE WHEN yes THEN 'fmri_gnn' END, old.c, CASE WHEN NOT yes THEN 'out_of_scope' END) AS category
FROM old FULL JOIN bin USING (paper_id) FULL JOIN new USING (paper_id)""")
def label_layered(spark, sf_dir):
    """Three logs out of one: legacy rows, binary answers, and the present log, whose rows are sparse."""
    log = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "paper_id", "event_id": "ord"})
    pairs = [F.lit(x) for kv in _LEGACY.items() for x in kv]
    legacy = log.where("ord % 3 = 0").select("paper_id", F.create_map(*pairs)[F.col("event_type")].alias("category"), "ord")
    binary = log.where("ord % 3 = 1").select("paper_id", (F.col("value") > 250).alias("is_positive"), "ord")
    new = log.where("ord % 3 = 2 and value > 450").select("paper_id", F.col("event_type").alias("category"), "ord")
    return L.layered_labels(legacy, binary, new)


@query(f"WITH {_REDUCED} SELECT category, count(*) AS n FROM reduced GROUP BY 1")
def category_counts(spark, sf_dir):
    return L.category_counts(L.reduced_labels(label_log(spark, sf_dir)))


@query(f"WITH {_REDUCED}, {_YEARS} SELECT category, count(*) AS n FROM reduced JOIN years USING (paper_id) WHERE year >= 1996 GROUP BY 1")
def category_counts_since(spark, sf_dir):
    return L.category_counts(L.reduced_labels(label_log(spark, sf_dir)), paper_years(spark, sf_dir), 1996)


@query(f"""
WITH {_REDUCED}, known AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'none_such']) AS category)
SELECT category AS item, count(paper_id) AS n FROM known LEFT JOIN reduced USING (category) GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM reduced UNION ALL SELECT 'core', 0 UNION ALL SELECT 'secondary', 0 UNION ALL SELECT 'excluded', 0
UNION ALL SELECT 'pending', count(DISTINCT c_custkey) FROM customer WHERE c_custkey NOT IN (SELECT paper_id FROM reduced)""")
def category_status(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"))
    return L.category_status(L.reduced_labels(label_log(spark, sf_dir)), asked, (*TYPES, "none_such"))


@query(f"""
WITH {_REDUCED}, raw AS (SELECT event_type AS category, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 1) AS pct FROM events GROUP BY 1)
SELECT category, raw.n AS n_raw, pct, coalesce(r.n, 0) AS n_reduced FROM raw LEFT JOIN (SELECT category, count(*) AS n FROM reduced GROUP BY 1) r USING (category)""")
def raw_vs_reduced(spark, sf_dir):
    log = label_log(spark, sf_dir)
    counts = L.category_counts(L.reduced_labels(log)).withColumnRenamed("n", "n_reduced")
    return L.distribution(log).withColumnRenamed("n", "n_raw").join(counts, "category", "left").na.fill(0, ["n_reduced"])


@query(f"WITH {_REDUCED}, {_YEARS} SELECT paper_id FROM reduced JOIN years USING (paper_id) WHERE category = 'view' AND tier >= 2 AND year BETWEEN 1995 AND 1996 AND node_type IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')")
def papers_in_category(spark, sf_dir):
    labels = L.reduced_labels(label_log(spark, sf_dir))
    return L.papers_in_category(
        labels, "view", papers=paper_years(spark, sf_dir), year_min=1995, year_max=1996, node_types=["AUTOMOBILE", "BUILDING", "MACHINERY"], tier_min="haiku-repass", categories=TYPES
    )


@query("""
WITH q AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END AS a, CASE WHEN toxic = 1 THEN 'bad' WHEN toxic = 0 THEN 'good' END AS b FROM labels)
SELECT coalesce(a, 'unknown') AS first, coalesce(b, 'unknown') AS second, count(*) AS n FROM documents LEFT JOIN q USING (doc_id) GROUP BY 1, 2""")
def audit_agreement(spark, sf_dir):
    sample, first, second = _labellers(spark, sf_dir)
    return L.agreement(sample, first, second)


def _labellers(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "paper_id")
    sample = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"))
    first = labels.select("paper_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").alias("category"))
    second = labels.select("paper_id", F.when(F.col("toxic") == 1, "bad").when(F.col("toxic") == 0, "good").alias("category"))
    return sample, first, second


@query("""
WITH q AS (SELECT coalesce(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END, 'unknown') = coalesce(CASE WHEN toxic = 1 THEN 'bad' WHEN toxic = 0 THEN 'good' END, 'unknown') AS same
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT count(*) FILTER (same) AS agreement, count(*) FILTER (NOT same) AS disagreement, round(count(*) FILTER (same) / count(*)::DOUBLE, 4) AS agreement_rate FROM q""")
def audit_rate(spark, sf_dir):
    return L.agreement_rate(L.agreement(*_labellers(spark, sf_dir)))


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 50 AS BIGINT) AS batch, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS place FROM documents")
def classify_batches(spark, sf_dir):
    return L.numbered_batches(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")], 50)


@query("""
SELECT CAST(event_id AS VARCHAR) AS paper_id, CASE CAST(CAST(trunc(value) AS INT) % 9 AS VARCHAR) WHEN '1' THEN 'fmri_gnn' WHEN '2' THEN 'fmri_graph_classical' WHEN '3' THEN 'fmri_geometric_manifold'
  WHEN '4' THEN 'fmri_no_graph' WHEN '5' THEN 'graph_methods_no_fmri' ELSE 'out_of_scope' END AS category, CAST(trunc(value) AS INT) % 9 IN (1, 2, 3) AS is_core, 'medium' AS confidence, 1 AS tier FROM events""")
def normalized_answers(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    code = F.pmod(F.col("value").cast("int"), F.lit(9)).cast("string")
    none = lambda kind: F.lit(None).cast(kind)
    rows = events.select(
        F.lit("").alias("paper_id"), F.col("event_id").cast("string").alias("id"), F.concat(F.lit(" "), code).alias("category"), none("string").alias("confidence"),
        none("string").alias("reasoning"), none("string").alias("model"), none("int").alias("tier"),
    )
    return L.normalized_answers(rows).select("paper_id", "category", "is_core", "confidence", "tier")


@query("SELECT DISTINCT user_id AS paper_id FROM events WHERE event_type = 'purchase'")
def any_label(spark, sf_dir):
    log = label_log(spark, sf_dir).withColumn("category", F.when(F.col("category") == "purchase", "fmri_gnn"))
    return L.any_core(log)


@query("SELECT c_custkey AS paper_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def unclassified_papers(spark, sf_dir):
    papers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"))
    return L.unclassified(papers.unionByName(papers), label_log(spark, sf_dir))


@query(f"WITH {_REDUCED} SELECT paper_id, category, CAST(tier AS INT) AS tier FROM reduced")
def incremental_labels(spark, sf_dir):
    """The log as a stream of three batches into keyed state, each a run that goes on from the one before: the same as reducing
    it at once."""
    place = scratch(spark, "labels")
    log = label_log(spark, sf_dir)
    stream = None
    # a state's partitions stay as they are for its life; a small log needs few
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(max(4, log.count() // ROWS_A_STATE), int(width)))
    try:
        for part in range(3):
            log.where(F.col("ord") % 3 == part).write.mode("append").parquet(f"{place}/log")
            stream = stream or keyed.label_changes(spark.readStream.schema(log.schema).parquet(f"{place}/log"))
            keyed.kept(stream, f"{place}/changes", f"{place}/checkpoint").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    return keyed.labels(spark, f"{place}/changes").select("paper_id", "category", "tier")


@query("SELECT event_type, date_trunc('day', ts)::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2")
def event_days(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    counts = logs.event_windows(events.withColumn("ts", F.col("ts").cast("timestamp")))
    return counts.select("event_type", F.to_date("window.start").alias("day"), "n")


@query("SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def log_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(records.json_field("props", "$.k", "int").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT CAST(user_id AS VARCHAR) AS paper_id, event_type AS category FROM events")
def log_extract(spark, sf_dir):
    """Answers out of agent-log lines, alone or in a message's content."""

    events = table(spark, sf_dir, "events")
    answer = F.to_json(F.struct(F.col("user_id").cast("string").alias("paper_id"), F.col("event_type").alias("category")))
    wrapped = F.to_json(F.struct(F.struct(F.concat(F.lit("done\\n"), answer, F.lit("\\nend")).alias("content")).alias("message")))
    return records.answers_in_logs(events.select(F.when(F.col("event_id") % 2 == 0, answer).otherwise(wrapped).alias("value")))


@query("SELECT CAST(user_id AS VARCHAR) AS paper_id, event_type AS category FROM events")
def text_answers(spark, sf_dir):
    """Answers out of texts: a JSON array within words, or lines of which some are JSON objects."""
    events = table(spark, sf_dir, "events")
    answer = F.to_json(F.struct(F.col("user_id").cast("string").alias("paper_id"), F.col("event_type").alias("category")))
    array = F.concat(F.lit("Here you are: ["), answer, F.lit("] and that is all."))
    lines = F.concat(F.lit("Answers\n"), answer, F.lit("\nno more {of them}"))
    return records.answers_in_text(events.select(F.when(F.col("event_id") % 2 == 0, array).otherwise(lines).alias("value"))).select("paper_id", "category")
