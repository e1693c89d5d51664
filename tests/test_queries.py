"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as contract
from tandem.workload.oracle import ORACLES
from tandem.workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
SQL = {name: sql for name, sql in ORACLES.items() if name in QUERIES}


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for name in ("customer", "orders", "lineitem", "events"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bool, str)):
        return value
    return float(value) if isinstance(value, (int, float)) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, views, name):
    df = QUERIES[name](spark, SF)
    found = views.sql(SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    order = [found.columns.index(c) for c in df.columns]
    expected = Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in df.collect()) == expected


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_only_fitted_models_have_no_sql():
    assert set(QUERIES) - set(SQL) == {
        "cross_validation", "model_predictions", "feature_importances", "tree_nodes", "tree_rules", "tree_parity",
    }


def test_results_do_not_depend_on_the_number_of_shuffle_partitions(spark):
    seen = []
    for n in ("3", "31"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = QUERIES["stratified_folds"](spark, SF).collect()
        seen.append(Counter(map(tuple, rows)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]


def test_the_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
