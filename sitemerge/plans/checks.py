"""The quality reports (Q-*) over the pipeline's states and staging tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import ambiguous, check_fk, check_length, check_pk, check_range, dropped, key_clashes
from ..sources.targets import TABLES
from .loads import ORDER, employee_territory_candidates
from .queries import after_load, context, fixture
from .stored_queries import report_queries


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _key_text(cols: list[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def _after(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: after_load(spark, sf_dir, name) for name in ORDER}


def q_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key violations in every table after the pipeline, and in the
    employee-territory pairs the insert had to reject (unknown territory)."""
    after = _after(spark, sf_dir)
    parts = []
    for name in ORDER:
        pk = list(TABLES[name].pk)
        bad = check_pk(after[name], pk)
        parts.append(bad.select(F.lit(name).alias("table_name"), _key_text(pk).alias("key_text"),
                                "problem", F.col("n").cast("long").alias("n")))
    ctx = context(spark, sf_dir, "employee_territory")
    pk = list(TABLES["employee_territory"].pk)
    cand = employee_territory_candidates(ctx, ctx.state["employee_territory"]).select(*pk).distinct()
    parts.append(check_pk(cand, pk).select(
        F.lit("employee_territory_new").alias("table_name"), _key_text(pk).alias("key_text"),
        "problem", F.col("n").cast("long").alias("n")))
    return _union(parts)


def q_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan count of each of the 21 foreign keys after the pipeline."""
    after = _after(spark, sf_dir)
    parts = []
    for name in ORDER:
        for fk in TABLES[name].fks:
            orphans = check_fk(after[name], list(fk.cols), after[fk.parent], list(fk.parent_cols))
            parts.append(orphans.agg(F.count(F.lit(1)).cast("long").alias("orphans")).select(
                F.lit(name).alias("table_name"), F.lit(",".join(fk.cols)).alias("fk_cols"),
                F.lit(fk.parent).alias("parent"), "orphans"))
    return _union(parts)


def q_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest value and over-width count of every width-limited column."""
    after = _after(spark, sf_dir)
    return _union([check_length(after[n], TABLES[n]) for n in ORDER if
                   any(c.width for c in TABLES[n].cols)])


# Staging columns that an insert narrows to a target type.
NARROWED = {
    "Stg_Region": [("RegionID", T.ShortType())],
    "Stg_SalesPerson": [("SalesPersonId", T.ShortType())],
    "Stg_Employees": [("EmployeeID", T.ShortType())],
    "Stg_StockItem": [("Cost", T.DecimalType(5, 2)), ("RetailPrice", T.DecimalType(5, 2))],
    "Stg_Products": [("UnitPrice", T.DecimalType(5, 2)), ("WholesalePrice", T.DecimalType(5, 2))],
    "Stg_Orders": [("Freight", T.DecimalType(19, 4))],
    "Stg_OrderLine": [("UnitPrice", T.DecimalType(18, 0)), ("TaxRate", T.DecimalType(18, 0))],
    "Stg_OrderDetails": [("UnitPrice", T.DecimalType(18, 0)), ("Discount", T.DecimalType(18, 0))],
}


def q_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = fixture(spark, sf_dir)["stg"]
    return _union([check_range(stg[s], s, items) for s, items in NARROWED.items()])


# (table, site 1 staging, site 1 key, site 2 staging, site 2 key); the keys
# are compared as text, as the loads compare them with the site left out.
CLASH_KEYS = [
    ("customer", "Stg_Customer", "CustomerId", "Stg_Customers", "CustomerID"),
    ("employee", "Stg_SalesPerson", "SalesPersonId", "Stg_Employees", "EmployeeID"),
    ("supplier", "Stg_Supplier", "SupplierId", "Stg_Suppliers", "SupplierID"),
    ("product", "Stg_StockItem", "StockItemId", "Stg_Products", "ProductID"),
    ("order", "Stg_OrderHeader", "OrderId", "Stg_Orders", "OrderID"),
    ("order_detail", "Stg_OrderLine", "OrderLineId", "Stg_OrderDetails", "OrderID"),
]


def q_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: source keys present in both sites (R1)."""
    stg = fixture(spark, sf_dir)["stg"]
    parts = []
    for table, s1, k1, s2, k2 in CLASH_KEYS:
        clashes = key_clashes(stg[s1], F.col(k1).cast("string"), stg[s2], F.col(k2).cast("string"))
        parts.append(clashes.agg(F.count(F.lit(1)).cast("long").alias("clashes")).select(
            F.lit(table).alias("table_name"), "clashes"))
    return _union(parts)


def q_fan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address texts that resolve to several addresses (R3), per lookup."""
    addr = after_load(spark, sf_dir, "address")
    lookups = [
        ("full_address", addr, ["full_address"]),
        ("full_address_site1", addr.where(F.col("site_id") == 1), ["full_address"]),
        ("full_address_site2", addr.where(F.col("site_id") == 2), ["full_address"]),
        ("full_address_country", addr, ["full_address", "country"]),
    ]
    return _union([
        ambiguous(ref, keys, "ODS_address_id").select(
            F.lit(name).alias("lookup"), _key_text(keys).alias("key_text"),
            F.col("matches").cast("long").alias("matches"), "min_id", "max_id")
        for name, ref, keys in lookups
    ])


def q_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per insert arm with an inner lookup: source rows it loses (R6)."""
    fx = fixture(spark, sf_dir)
    stg = fx["stg"]
    address = after_load(spark, sf_dir, "address")
    employee = after_load(spark, sf_dir, "employee")
    supplier = after_load(spark, sf_dir, "supplier")
    emp = lambda s: employee.where(F.col("record_orig_site_id") == s)
    sup = lambda s: supplier.where(F.col("site_id") == s)
    cases = [
        ("customer_2", stg["Stg_Customers"], address.where(F.col("site_id") == 2),
         [("Address", "full_address")]),
        ("employee_territory", stg["Stg_EmployeeTerritories"], emp(2),
         [("EmployeeID", "orig_employee_id")]),
        ("product_1", stg["Stg_StockItem"], sup(1), [("SupplierId", "orig_supplier_id")]),
        ("product_2", stg["Stg_Products"], sup(2), [("SupplierID", "orig_supplier_id")]),
        ("order_1", stg["Stg_OrderHeader"], emp(1), [("SalesPersonId", "orig_employee_id")]),
        ("order_2", stg["Stg_Orders"], emp(2), [("EmployeeID", "orig_employee_id")]),
    ]
    parts = []
    for arm, src, ref, on in cases:
        lost = dropped(src, ref, on).agg(F.count(F.lit(1)).cast("long").alias("dropped"))
        total = src.agg(F.count(F.lit(1)).cast("long").alias("source_rows"))
        # two one-row aggregates joined on the arm name
        parts.append(total.select(F.lit(arm).alias("arm"), "source_rows")
                     .join(lost.select(F.lit(arm).alias("arm"), "dropped"), "arm"))
    return _union(parts)


def check_queries():
    return {"q_pk": q_pk, "q_fk": q_fk, "q_len": q_len, "q_range": q_range,
            "q_clash": q_clash, "q_fan": q_fan, "q_drop": q_drop, **report_queries()}
