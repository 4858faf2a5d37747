"""Every registered query against its SQL, on the smallest test tables."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from stratalake.plans.registry import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = queries()[name](spark, SF_DIR)
    expected = database.sql(oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = rows_of(result.columns, result.collect())
    want = rows_of(expected.columns, expected.fetchall())
    assert isinstance(got, Counter) and got == want


def test_without_what_the_corpus_queries_import():
    """The other queries are there if a library of the corpus part is not."""
    code = """
import subprocess
import sys
sys.modules["tiktoken"] = None
import warnings
with warnings.catch_warnings(record=True):
    warnings.simplefilter("always")
    import __spark_entry__
names = __spark_entry__.queries()
assert "raw_to_curated" in names and not [n for n in names if n.startswith("op1_")]
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
