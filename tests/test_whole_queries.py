"""Registered queries cover all symbols of their tables."""

import os

import pytest

from workload import QUERIES
from workload.views import Views

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def symbols(spark):
    return sorted(r[0] for r in Views(spark, SF_DIR).trades.select("symbol").distinct().collect())


def test_models_for_every_symbol(spark):
    assert sorted(r.symbol for r in QUERIES["model_per_symbol"](spark, SF_DIR).collect()) == symbols(spark)


def test_reports_for_every_symbol(spark):
    got = {(r.symbol, r.split) for r in QUERIES["split_reports"](spark, SF_DIR).collect()}
    assert got == {(s, p) for s in symbols(spark) for p in ("train", "val", "test")}


def test_splits_of_every_symbol_are_compared(spark):
    assert sorted(r.symbol for r in QUERIES["split_compare_symbols"](spark, SF_DIR).collect()) == symbols(spark)
