"""The driver contract: entry runs, and each registered query equals its
DuckDB oracle on the sf0.01 tables (scripts/check_oracle.py runs the corpus
queries' SQL too)."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import ROOT, SF

TABLES = ["customer", "orders", "events", "part", "lineitem", "embeddings"]
CORE = sorted(set(E.oracle_sql()) - set(E.CORPUS.QUERIES if E.CORPUS else ()) - {"pipeline"})


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["ownership", "center_id", "distance"]
    assert len(rows) == 5


def test_entry_without_the_corpus_operators(tmp_path):
    """A copy without their folder (the pipeline file may stay) still imports and registers every core query."""
    away = shutil.ignore_patterns(".git", "llm", "__pycache__")
    copy = Path(shutil.copytree(ROOT, tmp_path / "copy", ignore=away))
    assert not (copy / "omphalos" / "llm").exists()
    code = "import __spark_entry__ as E; assert E.CORPUS is E.PIPELINE is None; print(sorted(E.queries()) == sorted(E.oracle_sql()), len(E.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, timeout=300)
    assert done.stdout.split() == ["True", str(len(CORE))], done.stderr


def test_every_query_has_an_oracle():
    corpus = {*E.CORPUS.QUERIES, "pipeline"} if E.CORPUS else set()
    assert set(E.queries()) - corpus == set(E.oracle_sql()) - corpus
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _norm(df.columns, rows) == _norm(rel.columns, rel.fetchall())
