"""Every SQL-checked registered query equals its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from check_oracles import compare, connect
from sf_paths import SF_SMALL

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert compare(sdf, odf) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "hist_o_totalprice_mean" in df.columns
