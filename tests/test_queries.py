"""Every registered query beside its SQL twin, on the smallest tables."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import entry
from fixtures import ORACLES, QUERIES
from millrace.testing.oracle import compare, connect

SQL = ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert df.columns
        return
    result = compare(df, con, SQL[name])
    assert result["types"][0] == result["types"][1]
    assert result["ok"], (result["rows"], result["only_ours"], result["only_theirs"])


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("src_", "snk_"))))
def test_plan_has_no_cross_join(spark, sf_dir, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, sf_dir).explain()
    plan = out.getvalue()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search("PythonUDF|BatchEvalPython|ArrowEvalPython", plan)
