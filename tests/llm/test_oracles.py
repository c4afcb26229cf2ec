"""The queries that SQL can say, against their SQL over whole tables."""

import pytest
from compare import difference, duck

from dropwatch.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    problem, rows = difference(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name])
    assert problem is None and rows > 0
