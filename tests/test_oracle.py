"""Every registered query against its DuckDB oracle, on the sf0.001 tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from sievekit.plans import ORACLE_SQL as SQL  # noqa: E402
from sievekit.plans import QUERIES  # noqa: E402
from tools.compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    problems, _n, _secs = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["check", "name", "status", "n_violations"] and len(rows) == 14
