"""Every registered query against its SQL on the small tables."""

import re

import __spark_entry__ as contract
import pytest
from compare import difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), FOLDER, SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    without = {name for name in set(QUERIES) - set(SQL)
               if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert not without


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == ["country", "region", "month", "nb_orders", "revenue", "avg_basket",
                              "pct_global_revenue"]
    assert not result.isEmpty()


def test_sample_repeats_for_its_seed(spark):
    first, second = (QUERIES["seeded_sample"](spark, FOLDER).collect() for _ in range(2))
    assert first == second and len(first) > 0
