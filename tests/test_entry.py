import pytest

import __spark_entry__ as entry
from tests.duck import ROOT, check, connection

CORE = {n: q for n, q in entry.queries().items() if not q.__module__.startswith("voxsieve.llm")}


@pytest.fixture(scope="module")
def con():
    return connection("sf0.001")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(CORE)))
def test_agrees_with_sql(spark, con, name):
    check(CORE[name](spark, f"{ROOT}/sf0.001"), con, entry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(CORE) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert CORE[name](spark, f"{ROOT}/sf0.001").columns


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
