"""Every registered core query against its SQL, and the driver contract without the optional parts."""

import os
import subprocess
import sys

import oracle
import pytest

from zonalith.plans import catalog


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert oracle.difference(spark, db, name, catalog.QUERIES[name], catalog.ORACLE[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_other_queries_return_rows(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_contract():
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 60; print('ok')"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True).stdout.strip() == "ok"


def test_plans_prune_and_push(spark, sf_dir):
    plan = catalog.QUERIES["weighted_stats"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "l_shipdate" not in plan.split("ReadSchema")[-1]
    plan = catalog.QUERIES["eligible_lands"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "EqualTo(c_nationkey,3)" in plan and "PythonUDF" not in plan
