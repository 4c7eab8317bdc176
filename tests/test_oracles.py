"""Every query with an SQL counterpart against DuckDB on the smallest tables; the others must give rows."""

from __future__ import annotations

import importlib
import pkgutil

import pytest

import lexloom.plans
from lexloom.plans.catalogue import ORACLES, QUERIES
from tests.compare import connect, same

SF = "/root/testdata/sf0.001"
for module in pkgutil.iter_modules(lexloom.plans.__path__):
    importlib.import_module(f"lexloom.plans.{module.name}")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    same(QUERIES[name](spark, SF), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
