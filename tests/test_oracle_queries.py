"""Every binding of the reference's operators against its DuckDB oracle (the
driver's gate), with plan assertions on the returned frame and on every frame
that the binding writes on its way: no nested-loop or cartesian joins, no
Python functions of rows or columns."""

import os

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from oracle import compare
from rollsnap.plans import ORACLES, QUERIES, load_all

load_all()
SF = os.environ.get("ROLLSNAP_TEST_SF", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only: set[str] = set()
    assert set(QUERIES) - set(ORACLES) <= rows_only


def test_entry_lists_every_binding():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


_PLAN_BANNED = ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture
def written_plans(monkeypatch):
    """Plans of the frames written while the test runs."""
    plans = []
    for method in ("save", "parquet", "json", "csv", "text", "insertInto"):
        plain = getattr(DataFrameWriter, method)

        def write(self, *args, _plain=plain, **kwargs):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return _plain(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, method, write)
    return plans


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, written_plans, name):
    built = []

    def build(s, d):
        built.append(QUERIES[name](s, d))
        return built[0]

    ok, msg = compare(spark, build, ORACLES[name], SF)
    assert ok, msg
    for plan in (built[0]._jdf.queryExecution().executedPlan().toString(), *written_plans):
        for bad in _PLAN_BANNED:
            assert bad not in plan, f"{name} plans a {bad}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "state_voter_id" in df.columns
