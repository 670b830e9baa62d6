"""Behaviour found by reading the loads (R1-R13, V3, V10), on micro tables:
faithful by default, repaired under ``Options(strict=True)`` where stated."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sitemerge.operators.quality import check_length, check_pk, dropped
from sitemerge.plans.loads import Ctx, Options, employee_territory_candidates, ts_literal
from sitemerge.plans.pipeline import run_load
from sitemerge.sources.staging import STAGING
from sitemerge.sources.targets import TABLES

T1 = dt.datetime(2024, 1, 1)


def stg(spark, **rows):
    return {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in STAGING.items()}


def state(spark, **rows):
    return {name: spark.createDataFrame(rows.get(name, []), t.schema) for name, t in TABLES.items()}


def ctx(spark, staging, st, strict=False):
    return Ctx(spark, staging, st, ts_literal("2024-11-24 00:00:00"), Options(strict=strict))


def run_twice(spark, staging, st, name, strict=False):
    first = run_load(ctx(spark, staging, st, strict), name)
    st2 = dict(st)
    st2[name] = spark.createDataFrame(first.collect(), TABLES[name].schema)
    return first, run_load(ctx(spark, staging, st2, strict), name)


def test_site_rerun_inserts_once(spark):
    first, second = run_twice(spark, stg(spark), state(spark), "site")
    assert first.count() == 2 and second.count() == 2


def test_null_address_reinserted_each_run(spark):
    cust = [("8", "C", None, "T", "p", None, "City", None, "00001", "N", 2)]
    first, second = run_twice(spark, stg(spark, Stg_Customers=cust), state(spark), "address")
    assert first.count() == 1 and second.count() == 2
    first, second = run_twice(spark, stg(spark, Stg_Customers=cust), state(spark), "address",
                              strict=True)
    assert first.count() == 0 and second.count() == 0


def test_same_text_in_two_arms_is_one_row(spark):
    cust = [("8", "C", None, "T", "p", "Road 1", "City", "R1", "00001", "N", 2)]
    sup = [(8, "S", "c", "t", "p", "Road 1", "City", "R1", "00001", "N", 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Customers=cust, Stg_Suppliers=sup), state(spark)),
                   "address")
    assert out.count() == 1
    sup2 = [(8, "S", "c", "t", "p", "Road 1", "Other", "R1", "00001", "N", 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Customers=cust, Stg_Suppliers=sup2), state(spark)),
                   "address")
    assert out.count() == 2


def _supplier_row(i, orig, site, name):
    return (i, orig, name, None, None, None, None, None, T1, None, site)


def test_site_clash_updates_cross_sites(spark):
    st = state(spark, supplier=[_supplier_row(1, 7, 1, "old"), _supplier_row(2, 7, 2, "old")])
    s1 = [(7, "A", None, None, None, 7, 1)]
    s2 = [(7, "B", None, None, None, None, None, None, None, None, 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Supplier=s1, Stg_Suppliers=s2), st), "supplier")
    assert sorted(r["company_name"] for r in out.collect()) == ["B", "B"]


def _od_state(spark, tax):
    order = [(1, 9, None, None, None, None, None, None, None, None, None, None, T1, None, 1)]
    product = [(1, 5) + (None,) * 15 + (T1, None, 1)]
    od = [(1, 91, 1, 1, 3, Decimal(10), tax, None, None, T1, None, 1)]
    return state(spark, order=order, product=product, order_detail=od)


def test_tax_rounding_updates_every_run_unless_strict(spark):
    line = [(91, 9, 5, 3, Decimal("10.00"), Decimal("0.15"), None, 1)]
    for strict, expect in ((False, 1), (True, 0)):
        out = run_load(ctx(spark, stg(spark, Stg_OrderLine=line), _od_state(spark, Decimal(0)),
                           strict), "order_detail")
        updated = out.where(F.col("last_update").isNotNull()).count()
        assert updated == expect, strict


def test_later_line_of_known_order_not_inserted(spark):
    st = _od_state(spark, None)
    st["order_detail"] = spark.createDataFrame(
        [(1, 9, 1, 1, 3, Decimal(10), None, None, Decimal(0), T1, None, 2)],
        TABLES["order_detail"].schema)
    st["order"] = spark.createDataFrame(
        [(1, 9) + (None,) * 10 + (T1, None, 2)], TABLES["order"].schema)
    st["product"] = spark.createDataFrame([(1, 5) + (None,) * 15 + (T1, None, 2)],
                                          TABLES["product"].schema)
    lines = [(9, 5, 3, Decimal("10.00"), Decimal("0.00"), 2), (9, 6, 4, Decimal("12.00"), None, 2)]
    out = run_load(ctx(spark, stg(spark, Stg_OrderDetails=lines), st), "order_detail")
    assert out.count() == 1


def _addr(i, text, country):
    return (i, None, text, "c", None, None, country, T1, None, 2)


def test_address_fanout_multiplies_orders(spark):
    st = state(spark, address=[_addr(1, "Dock 1", "N"), _addr(2, "Dock 1", "N")],
               employee=[(1, 4) + (None,) * 11 + (T1, None, 2)])
    orders = [(50, "3", 4, T1, T1, 0, None, "Dock 1", "c", "r", "p", "N", 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Orders=orders), st), "order")
    assert sorted(r["ODS_address_id"] for r in out.collect()) == [1, 2]


def test_unresolved_employee_dropped_and_reported(spark):
    headers = [(5, 3, 99, T1, None, "PO5", 1)]
    s = stg(spark, Stg_OrderHeader=headers)
    out = run_load(ctx(spark, s, state(spark)), "order")
    assert out.count() == 0
    emp = state(spark)["employee"].where(F.col("record_orig_site_id") == 1)
    assert dropped(s["Stg_OrderHeader"], emp, [("SalesPersonId", "orig_employee_id")]).count() == 1


def test_missing_territory_rejected_and_reported(spark):
    st = state(spark, employee=[(1, 4) + (None,) * 11 + (T1, None, 2)])
    s = stg(spark, Stg_EmployeeTerritories=[(4, "99999")])
    c = ctx(spark, s, st)
    assert run_load(c, "employee_territory").count() == 0
    cand = employee_territory_candidates(c, st["employee_territory"]).select(
        "ODS_employee_id", "ODS_territory_id")
    bad = check_pk(cand, ["ODS_employee_id", "ODS_territory_id"]).collect()
    assert [(r["problem"], r["n"]) for r in bad] == [("null", 1)]


def test_null_quantity_per_outer_updates_every_run_unless_strict(spark):
    item = [(3, "n", 1, 1, "c", "s", None, Decimal("1.00"), Decimal("1.00"), 1, 1)]
    inv = [(3, 1, 1, 1, "B1", T1)]
    cat = [(1, "cat")]
    sup = [(1, 1) + (None,) * 6 + (T1, None, 1)]
    prod = [(1, 3, "n", "cat", None, 1, "c", "s", None, Decimal("1.00"), Decimal("1.00"), 1, None,
             1, 1, "B1", False, T1, None, 1)]
    s = stg(spark, Stg_StockItem=item, Stg_StockItemInventory=inv, Stg_ItemCategory=cat)
    for strict, expect in ((False, 1), (True, 0)):
        out = run_load(ctx(spark, s, state(spark, supplier=sup, product=prod), strict), "product")
        assert out.where(F.col("last_update").isNotNull()).count() == expect, strict


def test_long_customer_id_reported(spark):
    df = spark.createDataFrame([(1, "123456")], "ODS_customer_id int, orig_customer_id string")
    table = TABLES["customer"]
    full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(table.col(c).dtype).alias(c)
                       for c in table.names])
    rep = {r["column_name"]: r for r in check_length(full, table).collect()}
    assert rep["orig_customer_id"]["over_width"] == 1
    assert rep["orig_customer_id"]["max_length"] == 6


def test_later_line_inserted_and_settled_in_strict_mode(spark):
    st = _od_state(spark, None)
    st["order_detail"] = spark.createDataFrame(
        [(1, 9, 1, 1, 3, Decimal(10), None, None, Decimal(0), T1, None, 2)],
        TABLES["order_detail"].schema)
    st["order"] = spark.createDataFrame([(1, 9) + (None,) * 10 + (T1, None, 2)], TABLES["order"].schema)
    st["product"] = spark.createDataFrame([(1, 5) + (None,) * 15 + (T1, None, 2),
                                           (2, 6) + (None,) * 15 + (T1, None, 2)],
                                          TABLES["product"].schema)
    lines = [(9, 5, 3, Decimal("10.00"), Decimal("0.00"), 2), (9, 6, 4, Decimal("12.00"), None, 2),
             (9, 6, 5, Decimal("12.00"), None, 2)]
    s = stg(spark, Stg_OrderDetails=lines)
    first, second = run_twice(spark, s, st, "order_detail", strict=True)
    assert first.count() == 2  # the product-6 line is new; its two source rows give one
    assert second.count() == 2
    assert second.where(F.col("last_update").isNotNull()).count() == 0


def test_site_clash_kept_apart_in_strict_mode(spark):
    st = state(spark, supplier=[_supplier_row(1, 7, 1, "old"), _supplier_row(2, 7, 2, "old")])
    s1 = [(7, "A", None, None, None, 7, 1)]
    s2 = [(7, "B", None, None, None, None, None, None, None, None, 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Supplier=s1, Stg_Suppliers=s2), st, strict=True),
                   "supplier")
    assert sorted((r["site_id"], r["company_name"]) for r in out.collect()) == [(1, "A"), (2, "B")]


def test_address_fanout_lowest_id_in_strict_mode(spark):
    st = state(spark, address=[_addr(1, "Dock 1", "N"), _addr(2, "Dock 1", "N")],
               employee=[(1, 4) + (None,) * 11 + (T1, None, 2)])
    orders = [(50, "3", 4, T1, T1, 0, None, "Dock 1", "c", "r", "p", "N", 2)]
    out = run_load(ctx(spark, stg(spark, Stg_Orders=orders), st, strict=True), "order")
    assert [r["ODS_address_id"] for r in out.collect()] == [1]
