"""Every registered query against its SQL on a second engine."""

import os
import subprocess
import sys

import pytest
from compare import duck, mismatch
from conftest import SF_DIR

import __spark_entry__ as entry_point
from realmwatch.plans.catalog import QUERIES
from realmwatch.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_point_offers_them_all():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["realmwatch.llm", "realmwatch.llm.queries", "corpus_pipeline", "tokenizers"])
def test_core_queries_stay_without_the_optional_part(missing):
    """In a process of its own, where importing one module fails."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
from realmwatch.plans.catalog import QUERIES
assert QUERIES.items() <= e.queries().items() and 'pipeline' not in e.queries()
"""
    home = os.path.dirname(os.path.abspath(entry_point.__file__))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=home)
