"""One query per building block of the loads, over the test tables.

Each exercises a single operator of the inventory (null-default equality,
CONCAT, the CASE flags, narrowing casts, typed NULLs, UNION, semi-join gates,
left, chained and self-aliased lookups, KEY-ID) on the staging tables and the
prior ODS state, so it can be compared with a plain SQL statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (
    concat_null_empty,
    discontinued_from_active,
    null_default_eq,
    termination_from_active,
    typed_null,
)
from ..operators.joins import gate, lookup
from ..operators.keys import assign_ids
from ..operators.upsert import union_distinct
from ..sources.fixtures import read_tables
from .loads import DEFAULT_LOAD_TS, ts_literal
from .pipeline import run_updates
from .queries import context, fixture


def _fx(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return fx["stg"], fx["prior"]


def q_null_default_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-ISNULL / FLT-EQNULL: site 2 employees against the stored rows."""
    stg, prior = _fx(spark, sf_dir)
    src = stg["Stg_Employees"].alias("s")
    tgt = prior["employee"].alias("t")
    pairs = src.join(tgt, F.col("s.EmployeeID") == F.col("t.orig_employee_id"))
    return pairs.select(
        F.col("t.ODS_employee_id").alias("ODS_employee_id"),
        null_default_eq("s.FirstName", "t.first_name", "text").alias("eq_first_name"),
        null_default_eq("s.BirthDate", "t.birth_date", "date").alias("eq_birth_date"),
        null_default_eq("s.TerminationDate", "t.termination_date", "date").alias("eq_termination_date"),
        null_default_eq(F.col("s.ReportsTo").cast("string"), "t.reports_to", "text").alias("eq_reports_to"),
        null_default_eq("s.EmailAddress", "t.email", "text").alias("eq_email"),
    )


def q_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-CHG + SNK-UPD: the address rows the address update changes."""
    ctx = context(spark, sf_dir, "address")
    upd = run_updates(ctx, "address")
    return upd.where(F.col("last_update") == ts_literal(DEFAULT_LOAD_TS)).select(
        "ODS_address_id", "full_address", "city", "state", "postal_code")


def q_concat_null_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-CONCAT: address lines joined with a blank, NULL read as empty."""
    stg, _ = _fx(spark, sf_dir)
    return stg["Stg_Address"].select(
        "AddressId", concat_null_empty("AddressLine1", F.lit(" "), "AddressLine2").alias("full_address"))


def q_flag_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-CASE-FLAG / FN-CAST-BIT: discontinued from the active flag."""
    stg, _ = _fx(spark, sf_dir)
    return stg["Stg_StockItem"].select(
        "StockItemId", "IsActive", discontinued_from_active("IsActive").alias("discontinued"))


def q_term_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-CASE-TERM / FN-NOW: termination date when inactive."""
    stg, _ = _fx(spark, sf_dir)
    return stg["Stg_SalesPerson"].select(
        "SalesPersonId", "IsActive",
        termination_from_active("IsActive", ts_literal(DEFAULT_LOAD_TS)).alias("termination_date"))


def q_cast_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-IMPLICIT / FN-CAST-V5 / FN-CAST-V20: the narrowing casts of inserts."""
    stg, _ = _fx(spark, sf_dir)
    lines = stg["Stg_OrderLine"].select(
        F.col("OrderLineId").alias("line_id"),
        F.col("UnitPrice").cast("decimal(18,0)").alias("unit_price"),
        F.col("TaxRate").cast("decimal(18,0)").alias("tax_rate"),
        F.col("Quantity").cast("string").alias("quantity_text"))
    return lines


def q_typed_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-NULL: columns one site lacks, as typed NULLs in a union."""
    stg, _ = _fx(spark, sf_dir)
    s1 = stg["Stg_StockItem"].select(
        F.col("StockItemId").alias("orig_product_id"), F.col("Color").alias("color"),
        typed_null("int").alias("units_on_order"), F.lit(1).cast("short").alias("site_id"))
    s2 = stg["Stg_Products"].select(
        F.col("ProductID").alias("orig_product_id"), typed_null("string").alias("color"),
        F.col("UnitsOnOrder").alias("units_on_order"), F.lit(2).cast("short").alias("site_id"))
    return s1.unionByName(s2)


def q_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-UNION / AGG-DISTINCT: address texts of four sources, duplicates
    removed over all columns (NULLs equal)."""
    stg, _ = _fx(spark, sf_dir)

    def arm(t, a, c, s, p, n):
        return stg[t].select(F.col(a).alias("full_address"), F.col(c).alias("city"),
                             F.col(s).alias("state"), F.col(p).alias("postal_code"),
                             F.col(n).alias("country"), F.col("SiteId").alias("site_id"))

    return union_distinct([
        arm("Stg_Customers", "Address", "City", "Region", "PostalCode", "Country"),
        arm("Stg_Employees", "Address", "City", "StateOrRegion", "PostalCode", "Country"),
        arm("Stg_Suppliers", "Address", "City", "StateOrRegion", "PostalCode", "Country"),
        arm("Stg_Orders", "ShipAddress", "ShipCity", "ShipStateOrRegion", "ShipPostalCode",
            "ShipCountry"),
    ])


def q_gate_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-GATE: order lines whose order and product exist for their site."""
    stg, prior = _fx(spark, sf_dir)
    src = gate(stg["Stg_OrderLine"], prior["order"], [("OrderId", "orig_order_id"), ("SiteId", "site_id")])
    src = gate(src, prior["product"], [("StockItemId", "orig_product_id"), ("SiteId", "site_id")])
    return src.select("OrderLineId", "OrderId", "StockItemId", "Quantity")


def q_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-LKP: territory to region id, unresolved kept as NULL."""
    stg, prior = _fx(spark, sf_dir)
    out = lookup(stg["Stg_Territories"], prior["region"], [("RegionID", "orig_region_id")],
                 {"ODS_region_id": "ODS_region_id"})
    return out.select("TerritoryID", "ODS_region_id")


def q_lookup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-CHAIN: order -> staging customer -> staging address -> ODS address."""
    stg, prior = _fx(spark, sf_dir)
    src = lookup(stg["Stg_OrderHeader"], stg["Stg_Customer"], [("CustomerId", "CustomerId")],
                 {"_deliv": "DeliveryAddressId"})
    src = lookup(src, stg["Stg_Address"], [("_deliv", "AddressId")], {"_addr_src": "AddressId"})
    src = lookup(src, prior["address"], [("_addr_src", "orig_address_id")],
                 {"ODS_address_id": "ODS_address_id"})
    return src.select("OrderId", "ODS_address_id")


def q_lookup_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-SELF-ALIAS / PRJ-TWICE: billing and delivery addresses of a customer
    through the same two tables under two aliases."""
    stg, prior = _fx(spark, sf_dir)
    addr = stg["Stg_Address"]
    src = lookup(stg["Stg_Customer"], addr, [("BillingAddressId", "AddressId")],
                 {"_b1": "AddressLine1", "_b2": "AddressLine2"})
    src = lookup(src, addr, [("DeliveryAddressId", "AddressId")],
                 {"_d1": "AddressLine1", "_d2": "AddressLine2"})
    site1 = prior["address"].where(F.col("site_id") == 1)
    src = lookup(src, site1, [(concat_null_empty("_b1", F.lit(" "), "_b2"), "full_address")],
                 {"ODS_address_id": "ODS_address_id"})
    src = lookup(src, site1, [(concat_null_empty("_d1", F.lit(" "), "_d2"), "full_address")],
                 {"ODS_delivery_address_id": "ODS_address_id"})
    return src.select("CustomerId", "ODS_address_id", "ODS_delivery_address_id")


def q_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-ID: dense ids for all distinct order lines in the order of all
    their columns, as ``row_number()`` would give them."""
    lines = read_tables(spark, sf_dir)["lineitem"].distinct()
    return assign_ids(lines, "line_id", lines.columns, start=0, dtype=T.LongType())


def operator_queries():
    return {
        "null_default_eq": q_null_default_eq,
        "changed_rows": q_changed_rows,
        "concat_null_empty": q_concat_null_empty,
        "flag_case": q_flag_case,
        "term_case": q_term_case,
        "cast_narrow": q_cast_narrow,
        "typed_nulls": q_typed_nulls,
        "union_distinct": q_union_distinct,
        "gate_semi": q_gate_semi,
        "lookup_left": q_lookup_left,
        "lookup_chain": q_lookup_chain,
        "lookup_twice": q_lookup_twice,
        "assign_ids": q_assign_ids,
    }
