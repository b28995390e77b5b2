"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import run_checks
from checks import all_checks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in run_checks.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(all_checks.QUERIES))
def test_query(name, spark, con):
    verdict, rows, *_ = run_checks.compare(
        name, all_checks.QUERIES[name], all_checks.ORACLES.get(name), spark, con, SF
    )
    assert verdict == "ok"  # a query without SQL does not pass
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(all_checks.ORACLES) <= set(all_checks.QUERIES)
