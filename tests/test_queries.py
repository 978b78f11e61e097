"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import database, difference
from checks.registry import ORACLES, QUERIES
from conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, connection, key):
    n_rows, found = difference(QUERIES[key](spark, SF_DIR), connection.sql(ORACLES[key]))
    assert found is None
    assert n_rows > 0


@pytest.mark.parametrize(
    "key", sorted(set(QUERIES) - {"layer_ingest", "layer_ingest_rows", "batch_export", "chunked_write"})
)
def test_no_python_on_rows(spark, key):
    plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    # The Markdown conversion is a function over Arrow batches; none takes a row at a time.
    assert ("ArrowEvalPython" in plan) == ("Python" in plan) == (key == "html_to_markdown") and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["batch", "chunk", "n_rows", "write_mode"]
    assert result.count() > 0
