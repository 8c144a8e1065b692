"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import check_oracles
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = str(TESTDATA / "sf0.001")

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return check_oracles.oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    verdict = check_oracles.compare(spark, con, name, FOLDER)
    assert verdict.startswith(("ok", "rows only")), verdict
    if name not in ("feature_high_water",):
        assert not verdict.endswith(" 0"), verdict


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
