"""Every query with an oracle returns the same rows as its DuckDB twin
(order-insensitive, doubles to 9 significant digits) on sf0.001."""

import pytest

from conftest import SF_SMALL
from postlens.plans import catalog
from tools.oracle_check import rows_of

ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    sdf = catalog.queries()[key](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    cur = duck.execute(ORACLES[key])
    ocols = [d[0] for d in cur.description]
    orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    assert rows_of(srows, cols, 9) == rows_of(orows, cols, 9)
