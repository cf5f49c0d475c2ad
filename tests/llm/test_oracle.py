"""The training-data queries that SQL expresses, against it."""

import pytest
from compare import connect, difference

from gavel.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), ORACLE[name], connect(sf_dir)) == ""
