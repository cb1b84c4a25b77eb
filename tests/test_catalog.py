import importlib.util
import os
import sys

import pytest

import __spark_entry__ as driver
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("CartesianProduct", "NestedLoop", "EvalPython", "PythonUDF") if x in plan]
    assert differences(df, con, driver.oracle_sql()[name]) == []


def test_entry_without_a_dependency_of_the_text_part(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("stationloom.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    spec = importlib.util.spec_from_file_location("entry_again", driver.__file__)
    again = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(again)
    assert set(again.queries()) == set(again.oracle_sql()) == set(QUERIES)


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns == ["station", "DateTime", "click", "error", "purchase", "signup", "view"] and df.count() > 0
