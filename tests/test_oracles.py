"""Every registered query against its DuckDB oracle (row count, columns, order-free values)."""

import pytest

from oracle_harness import canon, duck
from strata.plans.registry import KINDS, ORACLES, QUERIES, load_all

from conftest import SMALL

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SMALL).toPandas()
    if name not in ORACLES:
        assert KINDS[name] == "rows"
        assert len(sdf) > 0
        return
    ddf = con.execute(ORACLES[name]).df()
    sc, sr = canon(sdf)
    dc, dr = canon(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
