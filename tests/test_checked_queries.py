import pytest

import __spark_entry__ as entry_points
import oracle
from matchlake import checked_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(checked_queries.QUERIES) == set(checked_queries.SQL)
    assert set(checked_queries.QUERIES) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["league_season", "Local", "Empate", "Visitante"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(checked_queries.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = checked_queries.QUERIES[name](spark, SF_DIR)
    assert oracle.compare(df, con, checked_queries.SQL[name]) == []


def test_no_python_in_any_plan(spark):
    """Everything stays in native expressions."""
    for name in ("silver_fixtures", "gold_metrics", "merge_insert_new", "json_envelope"):
        df = checked_queries.QUERIES[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
