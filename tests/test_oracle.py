"""Every registered query against its SQL on the smallest data set."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module
from stratiform.plans.catalogue import ORACLES, QUERIES
from stratiform.session import tune

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_entry_does_without_the_training_data_operators(monkeypatch):
    monkeypatch.setattr(entry_module.importlib.util, "find_spec", lambda name: None)
    assert set(entry_module.queries()) == set(QUERIES) and set(entry_module.oracle_sql()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    problems = compare(QUERIES[name](tune(spark), SF_DIR), duck, ORACLES[name])
    assert [p for p in problems if p != "no rows"] == []
