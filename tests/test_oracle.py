"""Every registered query against its SQL counterpart, exactly."""

import pytest

import __spark_entry__ as entry_module
from tillroll.catalogue.all import REGISTRY
from tests.compare import differences, duck_rows, spark_rows

QUERIES = {name: q for name, q in entry_module.queries().items() if name in REGISTRY}
ORACLE = entry_module.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck, data_dir):
    result = spark_rows(QUERIES[name](spark, data_dir))
    assert name in ORACLE
    assert differences(result, duck_rows(duck, ORACLE[name])) == []


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() == 50
