"""Every registered query against its SQL on whole tables."""

import pytest
from oracle import compare
from workload import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, duck, sf_dir, name):
    assert compare(duck, registry.QUERIES[name](spark, sf_dir), registry.ORACLE[name]) > 0


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0
