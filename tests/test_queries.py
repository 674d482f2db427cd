"""Every registered query: against its SQL, and against the rules its plan must keep."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from shelfsense.registry.core import ORACLE_SQL, QUERIES
from shelfsense.sources import logical

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# The block product of the recommender is the one place with Python in the executors.
PYTHON_NODES = {
    name: {"FlatMapCoGroupsInPandas"} for name in ("als_recommend", "curated_recommendations", "lists_from_purchases")
}
ROWS_ONLY = {
    "als_fit_rmse", "als_predict", "als_learning_curve", "als_regularization_scan", "als_grid_search",
    "als_rank_search", "als_recommend", "als_roc_auc", "lists_from_purchases", "lists_for_new_users", "saved_model_lists",
}
# 81 fits each; test_runs_and_serving.py runs the same search with few cells.
LONG = {"als_grid_reg_001", "als_grid_reg_01"}


@pytest.fixture(scope="session")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def text(value) -> str:
    if value is None or value is pd.NaT or value != value:
        return "null"
    if hasattr(value, "year"):
        return str(value)[:10]
    return repr(float(value)) if isinstance(value, (int, float)) or hasattr(value, "dtype") else str(value)


def bag(df: pd.DataFrame) -> list:
    return sorted(tuple(map(text, row)) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_only_the_iterative_jobs_have_no_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == ROWS_ONLY
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query(spark, folder, duck, name):
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    physical = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical and "Join Cross" not in plan
    python = set(re.findall(r"\w*(?:Python|Pandas|Arrow)\w*", physical))
    assert python <= PYTHON_NODES.get(name, set())
    got = result.toPandas()
    if name in ROWS_ONLY:
        assert len(got) > 0
        return
    expected = duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert bag(got) == bag(expected)


def test_date_range_reaches_the_scan(spark, folder):
    physical = QUERIES["season_units"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*o_orderdate", physical)


def test_quantity_filter_reaches_the_scan(spark, folder):
    units = logical.table(spark, folder, "lineitem").where("l_quantity < 10").select("l_partkey")
    physical = units._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_quantity,10" in physical and "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in physical
