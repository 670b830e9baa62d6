"""A query builds the tables it reads and no others; references that grow are never broadcast."""

import pytest
from pyspark.sql import functions as F

from sitemerge.operators.joins import gate, lookup, new_rows
from sitemerge.plans.fixture_state import PriorStates
from sitemerge.plans.loads import ORDER
from sitemerge.plans.pipeline import READS, with_reads
from sitemerge.sources.fixtures import derive_staging

from .conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prior_tables_are_built_when_read(spark):
    prior = PriorStates(spark, derive_staging(spark, SMALL))
    assert prior["region"].count() > 0
    assert set(prior._built) == {"region"}
    assert set(prior.of(["supplier"])) == {"supplier"}
    assert set(prior._built) == {"region", "address", "supplier"}
    assert list(prior) == ORDER


def test_prior_rows_are_written_once(spark, monkeypatch):
    from sitemerge.operators import keys
    from sitemerge.plans import fixture_state

    written = []
    for module in (keys, fixture_state):
        monkeypatch.setattr(module, "materialize", lambda df, label, w=module.materialize: written.append(label) or w(df, label))
    prior = PriorStates(spark, derive_staging(spark, SMALL))
    assert prior["supplier"].count() > 0 and prior["site"].count() == 1
    assert sorted(written) == ["ids-ODS_address_id", "ids-ODS_supplier_id", "prior-site"]


def test_tables_with_those_they_read():
    assert with_reads(["region"]) == ["region"]
    assert with_reads(["product", "customer"]) == ["address", "customer", "supplier", "product"]
    assert set(with_reads(["order_detail"])) == set(ORDER) - {"site", "region", "territory", "employee_territory"}


def test_context_loads_what_the_load_reads(spark, monkeypatch):
    from sitemerge.plans import queries

    monkeypatch.setattr(queries, "_CACHE", {})
    ctx = queries.context(spark, SMALL, "territory")
    assert set(ctx.state) == {"territory", *READS["territory"]}
    fx = queries.fixture(spark, SMALL)
    assert set(fx["prior"]._built) == {"region", "territory"} and set(fx["after"]) == {"region"}


@pytest.mark.parametrize("join", [
    lambda a, b: gate(a, b, [("x", "k")]),
    lambda a, b: new_rows(a, b, [("x", "k")]),
    lambda a, b: lookup(a, b, [("x", "k")], {"w": "v"}),
    lambda a, b: lookup(a, b, [("x", "k")], {"w": "v"}, lowest=True)])
def test_references_that_grow_are_merged(spark, join):
    a = spark.range(100).withColumnRenamed("id", "x")
    b = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan = _plan(join(a, b))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "BroadcastHashJoin" in _plan(gate(a, b, [("x", "k")], small=True))
