"""Every registered query against its DuckDB SQL, rows and types."""

import pytest

import __spark_entry__ as entry_module
from estate.plans import oracles, queries
from tests.compare import differences

SQL, QUERIES = oracles.oracle_sql(), queries.queries()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, key):
    assert differences(QUERIES[key](spark, sf_dir), con, SQL[key]) == []


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["document_type", "file_count", "total_bytes", "total_gb"]
    assert result.count() == 8
