import pytest

from postlens.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    want = duck.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == columns
    rows = [dict(zip((d[0] for d in want.description), r, strict=True)) for r in want.fetchall()]
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
