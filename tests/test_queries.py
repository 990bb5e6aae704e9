"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from ledgersync.checks import registered
from ledgersync.checks.compare import compare

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = {name: q.spark for name, q in registered().items()}
ORACLE = {name: q.oracle() for name, q in registered().items()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert all(ORACLE.values())
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    note = compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name])
    assert note.startswith("ok") and "EMPTY" not in note, note


def test_entry_is_stable(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["contract_oid", "opportunity"] and df.count() > 0
