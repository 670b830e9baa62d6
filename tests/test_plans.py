"""Plan shape of the loads: no data row funnelled into one partition, no
cartesian product, anti-joins planned as anti-joins, filters at the scan."""

import pytest

from sitemerge.plans.loads import ORDER
from sitemerge.plans.pipeline import run_load, run_updates
from sitemerge.plans.queries import context

from .conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in ORDER if n != "site"])
def test_load_plan_shape(spark, name):
    ctx = context(spark, SMALL, name)
    plan = _plan(run_load(ctx, name))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["address", "order", "order_detail"])
def test_arms_use_left_anti(spark, name):
    from sitemerge.plans.loads import LOADS
    from sitemerge.plans.pipeline import _anti_target

    ctx = context(spark, SMALL, name)
    target = _anti_target(ctx, name, run_updates(ctx, name))
    for arm in LOADS[name].arms:
        plan = arm.build(ctx, target)._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" in plan, arm.name


def test_scan_is_pruned_and_filtered(spark):
    from sitemerge.sources.fixtures import derive_staging

    stg = derive_staging(spark, SMALL)
    plan = _plan(stg["Stg_OrderLine"].select("OrderLineId"))
    assert "PushedFilters" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_discount" not in scan and "l_returnflag" not in scan
