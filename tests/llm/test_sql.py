import pytest
from oracle import connect, difference

from linkloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, data, name):
    assert difference(queries.QUERIES[name](spark, data), connect(data), queries.SQL[name]) == ""
