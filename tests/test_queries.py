"""Every query with SQL against DuckDB on the smallest tables; the entry works without the corpus operators too."""

import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

from citeloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return c


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else v


def table(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, db, name):
    found = catalogue.queries()[name](spark, DATA)
    rows = table(found.collect(), found.columns)
    sql = catalogue.oracle_sql().get(name)
    if sql:
        cursor = db.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(found.columns)
        assert rows == table(cursor.fetchall(), names)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_corpus_operators(tmp_path):
    for name in ("citeloom", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name) if name.endswith(".py") else os.makedirs(tmp_path / name)
    for part in os.listdir(f"{ROOT}/citeloom"):
        if part not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/citeloom/{part}", tmp_path / "citeloom" / part)
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import __spark_entry__ as e; q = e.queries(); assert 'category_counts' in q and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    # the entry file is read where the link stands
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
