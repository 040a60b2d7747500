"""Every registered query against its SQL oracle (DuckDB) on the small tables."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, a, b, _, msg = compare(spark, con, SF_SMALL, name, E.queries()[name],
                                   E.oracle_sql().get(name))
    assert status in ("OK", "ROWS-ONLY"), f"{name}: {status} {a}/{b} {msg}"
    if status == "ROWS-ONLY":
        assert a is not None and a > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Metric", "Value"]
    assert len(rows) == 16


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
