"""Every registered query with SQL, over whole tables of the smallest scale."""

import pytest

from filmloom.workload import QUERIES, SQL
from tests.compare import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    ok, note = compare(spark, FOLDER, name, QUERIES[name], SQL[name])
    assert ok, note


def test_entry_has_stable_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["model", "segment", "n_users", "precision", "recall", "ndcg"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
