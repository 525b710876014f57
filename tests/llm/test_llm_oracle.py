"""The operators' queries against their SQL on whole tables."""

import pytest
from oracle import compare
from spoor.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, duck, sf_dir, name):
    assert compare(duck, queries.QUERIES[name](spark, sf_dir), queries.ORACLE[name]) > 0
