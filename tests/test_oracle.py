"""Every catalog query against its DuckDB SQL at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE
from tools.oracle_check import duck, rows_of, type_diffs

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_ORACLE)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert type_diffs(df, con, entry.oracle_sql()[name]) == []
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, drows)
