"""Every query that has SQL gives the rows that DuckDB gives, on the small tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from verify import compare, tables  # noqa: E402

from occspark import queries as occurrence  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    found = duckdb.connect()
    tables(found, sf_dir)
    return found


@pytest.mark.parametrize("name", sorted(occurrence.ORACLE_SQL))
def test_query_matches_sql(spark, con, sf_dir, name):
    ours = occurrence.QUERIES[name](spark, sf_dir).toPandas()
    assert compare(ours, con.sql(occurrence.ORACLE_SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(occurrence.QUERIES) - set(occurrence.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert occurrence.QUERIES[name](spark, sf_dir).columns


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(occurrence.QUERIES) <= set(entry.queries())
