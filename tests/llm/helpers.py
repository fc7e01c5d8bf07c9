"""Small tables for the corpus operators."""

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows, extra: bool = False) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]]); with extra columns whose names the operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("node", "home", "blob", "slot", "band", "key", "path", "n_words", "score", "component", "row"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def words(n: int, seed: int, vocabulary: int = 500) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def changed(text: str, seed: int, share: float) -> str:
    """The text with that share of its words replaced."""
    r = random.Random(seed)
    parts = text.split()
    for k in r.sample(range(len(parts)), int(share * len(parts))):
        parts[k] = f"x{r.randrange(10**6)}"
    return " ".join(parts)
