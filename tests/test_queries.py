import pytest
from compare import compare

from equitylake import page_queries  # noqa: F401
from equitylake.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, name):
    got, want = compare(spark, sf, QUERIES[name], SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
