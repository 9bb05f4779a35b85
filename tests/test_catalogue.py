"""Every query of the catalogue against its SQL in DuckDB, and what its plan must not have."""

from __future__ import annotations

import os

import pytest

from tessitura.plans import catalogue

DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(name, same):
    same(catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs_without_sql(name, spark):
    df = catalogue.QUERIES[name](spark, f"{DATA}/sf0.001")
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_plan_has_no_cross_join(name, spark):
    plan = catalogue.QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
    physical = catalogue.QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "CartesianProduct" not in physical
