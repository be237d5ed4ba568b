"""Every registered query against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    ours = {x for x in QUERIES if not x.startswith("op") and x != "pipeline"}
    assert {x for x in ours if x not in ORACLES} == {
        "salary_forest_predictions",
        "demand_forest_predictions",
        "predictions",
        "feature_importances",
        "top_features",
        "what_if_forest",
        "what_if_forest_by_importance",
    }


@pytest.mark.parametrize("name", sorted(x for x in ORACLES if not x.startswith("op")))
def test_query_equals_oracle(spark, sf_dir, tables, name):
    result = QUERIES[name](spark, sf_dir)
    answer = tables.execute(ORACLES[name])
    columns = [x[0] for x in answer.description]
    assert sorted(result.columns) == sorted(columns)
    want = [tuple(row[columns.index(c)] for c in result.columns) for row in answer.fetchall()]
    got = [tuple(row) for row in result.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(x for x in set(QUERIES) - set(ORACLES) if not x.startswith("op") and x != "pipeline"))
def test_other_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert registry.entry(spark).columns == ["skill", "frequency", "avg_salary"]
