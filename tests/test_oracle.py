"""Every registered query against its DuckDB statement, at sf0.001
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

from .conftest import ROOT, SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

# the training-data queries have tests of their own
QUERIES = {**entry_mod.load_queries(), **entry_mod.check_queries(), **entry_mod.operator_queries()}
ORACLE = {**entry_mod.oracle_statements(), **entry_mod.check_statements(), **entry_mod.operator_statements()}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    s_rows, s_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    d_rows, d_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "ODS_order_detail_id" in df.columns
