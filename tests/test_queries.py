"""Each registered query with SQL against DuckDB on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from tallyproof import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def rows(table):
    def plain(v):
        if isinstance(v, float):
            return None if v != v else float(f"{v:.10g}")
        return str(v) if isinstance(v, Decimal) else v

    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, sf, con, name):
    got = rows(catalog.QUERIES[name](spark, sf).toArrow())
    want = rows(con.sql(catalog.SQL[name]).to_arrow_table())
    assert got == want


def test_entry_and_registry(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_training_data_package():
    root = os.path.dirname(os.path.abspath(catalog.__file__))
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as f:
                    assert "tallyproof.llm" not in f.read(), n


def test_the_rest_works_without_the_training_data_package(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(catalog.__file__)))
    for gone in (["tallyproof/llm", "tests/llm"], ["tallyproof/llm", "tests/llm", "corpus_pipeline.py"]):
        tree = tmp_path / str(len(gone))
        shutil.copytree(root, tree, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
        for name in gone:
            if (tree / name).is_dir():
                shutil.rmtree(tree / name)
            elif (tree / name).exists():
                (tree / name).unlink()
        code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert set(s) <= set(q); print(len(q), sum(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q))"
        done = subprocess.run([sys.executable, "-c", code], cwd=tree, env={**os.environ, "PYTHONPATH": str(tree)}, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        assert done.stdout.split() == [str(len(catalog.QUERIES)), "0"]
