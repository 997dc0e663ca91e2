"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from masterlink.plans.oracle import ORACLE_SQL
from masterlink.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    assert len(set(cols)) == len(df.columns)
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == cols
    places = [list(found.columns).index(c) for c in cols]
    assert sorted(repr([plain(r[p]) for p in places]) for r in found.fetchall()) == rows


def test_entry_without_llm():
    """The entry module works where the optional subpackage is gone."""
    import subprocess
    import sys

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "masterlink.llm" or name == "corpus_pipeline":
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "resolve_master" in e.queries() and not any(n.startswith("op1") for n in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests", 1)[0])
