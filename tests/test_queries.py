"""Every registered query against its check SQL."""

import sys

import pytest

import __spark_entry__ as entry
from bankweave.plans import catalog
from tests.compare import compare, duck

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_check_belongs_to_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("broken", ["bankweave.llm", "bankweave.llm.queries", "corpus_pipeline"])
def test_other_queries_stay_when_the_corpus_operators_cannot_be_imported(monkeypatch, broken):
    monkeypatch.setitem(sys.modules, broken, None)  # an import of it fails from here on
    if broken == "bankweave.llm":
        monkeypatch.delitem(sys.modules, "bankweave.llm.queries", raising=False)
    with pytest.warns(UserWarning, match="left out"):
        found = entry.queries()
    with pytest.warns(UserWarning, match="left out"):
        checks = entry.oracle_sql()
    assert found.keys() == catalog.queries().keys() and checks.keys() == catalog.oracle_sql().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert "bank_entity" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, QUERIES[name], CHECKS[name], sf_dir)
    assert result.startswith("ok"), result
