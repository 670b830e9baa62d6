"""Staging tables derived from the driver's test tables.

The reference ships no data and never declares its staging tables, so the
test inputs are built from the TPC-H-like tables by fixed rules: odd keys go
to site 1, even keys to site 2, and a few columns get NULLs, shared texts or
missing parents on purpose (FIXTURES.md section 1).  Everything is a plain
projection of a scan, so the fixtures scale with the test tables.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import conform

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TEST_TABLES}


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pad5(c: Column) -> Column:
    """Padded to five characters; longer numbers stay whole."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.lit(5), F.length(text)), F.lit("0"))


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def derive_staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = read_tables(spark, sf_dir)
    c = F.col
    region, nation = t["region"], t["nation"]
    cust, supp, part = t["customer"], t["supplier"], t["part"]
    orders, line = t["orders"], t["lineitem"]
    users = t["events"].select("user_id").distinct()

    ck, uk, sk, pk, ok = c("c_custkey"), c("user_id"), c("s_suppkey"), c("p_partkey"), c("o_orderkey")
    odd = lambda k: k % 2 == 1  # noqa: E731  site 1
    even = lambda k: k % 2 == 0  # noqa: E731  site 2

    stg: dict[str, DataFrame] = {}
    stg["Stg_Region"] = region.select(
        c("r_regionkey").alias("RegionID"), c("r_name").alias("RegionDescription")
    )
    stg["Stg_Address"] = cust.where(odd(ck)).select(
        ck.alias("AddressId"),
        _cat(ck, " Main Street").alias("AddressLine1"),
        _null_when(ck % 4 == 1, _cat("Unit ", ck % 9)).alias("AddressLine2"),
        _cat("City ", ck % 50).alias("City"),
        _null_when(ck % 13 == 0, _cat("S", ck % 20)).alias("State"),
        _pad5(ck).alias("ZipCode"),
        F.lit(1).alias("RecordOrigSiteId"),
    )
    contact = _null_when(ck % 11 == 0, _cat("Contact ", ck))
    stg["Stg_Customer"] = cust.where(odd(ck)).select(
        ck.alias("CustomerId"),
        c("c_name").alias("CustomerName"),
        contact.alias("ContactName"),
        _cat("555-", ck).alias("PhoneNumber"),
        ck.alias("BillingAddressId"),
        F.when(ck % 3 == 0, F.lit(None))
        .when(ck % 3 == 1, ck)
        .otherwise(ck + 2)
        .alias("DeliveryAddressId"),
        F.lit(1).alias("RecordOrigSiteId"),
    )
    stg["Stg_Customers"] = cust.where(even(ck)).select(
        _s(ck).alias("CustomerID"),
        c("c_name").alias("CompanyName"),
        contact.alias("ContactName"),
        c("c_mktsegment").alias("ContactTitle"),
        _cat("556-", ck).alias("Phone"),
        _null_when(
            ck % 22 == 0, _cat("Avenue ", F.when(ck % 20 == 18, ck - 2).otherwise(ck))
        ).alias("Address"),
        _cat("City ", c("c_nationkey")).alias("City"),
        _null_when(ck % 3 == 0, _cat("R", c("c_nationkey"))).alias("Region"),
        _pad5(c("c_nationkey")).alias("PostalCode"),
        _cat("NATION_", c("c_nationkey")).alias("Country"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_SalesPerson"] = users.where(odd(uk)).select(
        uk.alias("SalesPersonId"),
        _cat("First", uk).alias("FirstName"),
        _cat("Last", uk).alias("LastName"),
        _cat("557-", uk).alias("PhoneNumber"),
        _null_when(uk % 11 == 0, _cat("u", uk, "@site1.test")).alias("Email"),
        F.when(uk % 7 == 0, 0).otherwise(1).alias("IsActive"),
        F.lit(1).alias("RecordOrigSiteId"),
    )
    stg["Stg_Employees"] = users.where(even(uk)).select(
        uk.alias("EmployeeID"),
        _cat("First", uk).alias("FirstName"),
        _cat("Last", uk).alias("LastName"),
        _cat("Job ", uk % 6).alias("JobTitle"),
        _null_when(uk % 9 == 0, _ts("1980-02-03 00:00:00")).alias("BirthDate"),
        _ts("2010-05-06 00:00:00").alias("HireDate"),
        F.when(uk % 8 == 0, _ts("2020-07-08 00:00:00")).alias("TerminationDate"),
        _cat("558-", uk).alias("HomePhone"),
        _null_when(
            uk % 6 == 0, _cat("Lane ", F.when(uk % 20 == 18, uk - 2).otherwise(uk))
        ).alias("Address"),
        _cat("City ", uk % 3).alias("City"),
        _cat("R", uk % 5).alias("StateOrRegion"),
        _pad5(uk).alias("PostalCode"),
        _cat("NATION_", uk % 25).alias("Country"),
        _cat("u", uk, "@site2.test").alias("EmailAddress"),
        F.when(uk == 0, F.lit(None)).otherwise(uk % 4).alias("ReportsTo"),
        _cat("note ", uk).alias("Notes"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_Supplier"] = supp.where(odd(sk)).select(
        sk.alias("SupplierId"),
        c("s_name").alias("SupplierName"),
        _cat("Contact ", sk).alias("ContactName"),
        _cat("559-", sk).alias("PhoneNumber"),
        _null_when(sk % 9 == 0, _cat("www", sk, ".test")).alias("Website"),
        sk.alias("AddressId"),
        F.lit(1).alias("SiteId"),
    )
    stg["Stg_Suppliers"] = supp.where(even(sk)).select(
        sk.alias("SupplierID"),
        c("s_name").alias("CompanyName"),
        _cat("Contact ", sk).alias("ContactName"),
        _cat("Title ", sk % 4).alias("ContactTitle"),
        _cat("560-", sk).alias("Phone"),
        _cat("Road ", sk).alias("Address"),
        _cat("City ", c("s_nationkey")).alias("City"),
        _cat("R", c("s_nationkey")).alias("StateOrRegion"),
        _pad5(c("s_nationkey")).alias("PostalCode"),
        _cat("NATION_", c("s_nationkey")).alias("Country"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_Territories"] = nation.select(
        _pad5(c("n_nationkey")).alias("TerritoryID"),
        c("n_name").alias("TerritoryDescription"),
        c("n_regionkey").alias("RegionID"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_EmployeeTerritories"] = users.where(even(uk)).select(
        uk.alias("EmployeeID"),
        F.when(uk % 10 == 4, F.lit("99999")).otherwise(_pad5(uk % 25)).alias("TerritoryID"),
    )
    size = c("p_size")
    stg["Stg_StockItem"] = part.where(odd(pk)).select(
        pk.alias("StockItemId"),
        c("p_name").alias("StockItemName"),
        (size % 6).alias("ItemCategoryId"),
        (2 * (pk % 5) + 1).alias("SupplierId"),
        c("p_brand").alias("Color"),
        c("p_type").alias("Size"),
        _null_when(pk % 9 == 0, size).alias("QuantityPerOuter"),
        c("p_retailprice").alias("Cost"),
        c("p_retailprice").alias("RetailPrice"),
        F.when(pk % 7 == 0, 0).otherwise(1).alias("IsActive"),
        F.lit(1).alias("SiteId"),
    )
    stg["Stg_StockItemInventory"] = part.where(odd(pk) & (pk % 5 != 0)).select(
        pk.alias("StockItemID"),
        (size * 3).alias("QuantityOnHand"),
        size.alias("ReorderLevel"),
        (size * 5).alias("TargetStockLevel"),
        _cat("B", size).alias("BinLocation"),
        _ts("2024-01-02 03:04:05").alias("LastEditDateTime"),
    )
    stg["Stg_ItemCategory"] = region.select(
        c("r_regionkey").alias("CategoryId"), c("r_name").alias("Category")
    )
    stg["Stg_Products"] = part.where(even(pk)).select(
        pk.alias("ProductID"),
        c("p_name").alias("ProductName"),
        (size % 6).alias("CategoryID"),
        (2 * (pk % 5)).alias("SupplierID"),
        _cat(size, " per box").alias("QuantityPerUnit"),
        c("p_retailprice").alias("UnitPrice"),
        _null_when(pk % 8 == 0, c("p_retailprice")).alias("WholesalePrice"),
        size.alias("UnitsInStock"),
        (size % 4).alias("UnitsOnOrder"),
        (size % 7).alias("ReorderLevel"),
        (pk % 12 == 0).alias("Discontinued"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_Categories"] = region.select(
        c("r_regionkey").alias("CategoryID"),
        c("r_name").alias("CategoryName"),
        _cat("All of ", c("r_name")).alias("Description"),
    )
    ock = c("o_custkey")
    stg["Stg_OrderHeader"] = orders.where(odd(ok)).select(
        ok.alias("OrderId"),
        ock.alias("CustomerId"),
        (2 * (ock % 7) + 1).alias("SalesPersonId"),
        c("o_orderdate").alias("OrderDate"),
        _null_when(ok % 9 == 0, c("o_orderdate") + F.expr("INTERVAL '3' DAY")).alias("ShipDate"),
        _cat("PO", ok).alias("CustomerPurchaseOrderNumber"),
        F.lit(1).alias("SiteId"),
    )
    stg["Stg_Orders"] = orders.where(even(ok)).select(
        ok.alias("OrderID"),
        _s(ock).alias("CustomerID"),
        (2 * (ock % 7)).alias("EmployeeID"),
        c("o_orderdate").alias("OrderDate"),
        (c("o_orderdate") + F.expr("INTERVAL '14' DAY")).alias("RequiredDate"),
        (ok % 4).alias("ShipVia"),
        _null_when(ok % 12 == 0, c("o_totalprice")).alias("Freight"),
        _null_when(ok % 50 == 0, _cat("Dock ", ock % 97)).alias("ShipAddress"),
        _cat("City ", ock % 2).alias("ShipCity"),
        _cat("R", ock % 2).alias("ShipStateOrRegion"),
        _pad5(ock % 97).alias("ShipPostalCode"),
        _cat("NATION_", ock % 25).alias("ShipCountry"),
        F.lit(2).alias("SiteId"),
    )
    stg["Stg_Shippers"] = region.where(c("r_regionkey") < 3).select(
        c("r_regionkey").alias("ShipperID"),
        _cat("Ship ", c("r_name")).alias("CompanyName"),
        _cat("561-", c("r_regionkey")).alias("Phone"),
    )
    lk = c("l_orderkey").cast("long")
    stg["Stg_OrderLine"] = line.where(odd(lk)).select(
        (lk * 10 + c("l_linenumber")).alias("OrderLineId"),
        lk.alias("OrderId"),
        c("l_partkey").alias("StockItemId"),
        c("l_quantity").alias("Quantity"),
        c("l_extendedprice").alias("UnitPrice"),
        c("l_tax").alias("TaxRate"),
        _null_when(c("l_linenumber") == 7, c("l_shipdate")).alias("ItemPickedDate"),
        F.lit(1).alias("SiteId"),
    )
    stg["Stg_OrderDetails"] = line.where(even(lk)).select(
        lk.alias("OrderID"),
        c("l_partkey").alias("ProductID"),
        c("l_quantity").alias("Quantity"),
        c("l_extendedprice").alias("UnitPrice"),
        c("l_discount").alias("Discount"),
        F.lit(2).alias("SiteId"),
    )
    return {name: conform(df, name) for name, df in stg.items()}


def raw_staging(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Site 1's customers and stock items as a system without the targets' widths sends
    them: account numbers of a branch before the customer id, contact names with the
    company's repeated, prices of a whole box."""
    c = F.col
    key, size = c("CustomerId"), F.coalesce(c("QuantityPerOuter"), F.lit(1))
    long_name = F.concat(c("ContactName"), F.lit(" of "), F.expr("repeat(CustomerName, CAST(CustomerId % 4 AS INT))"))
    box = lambda price: (c(price) * size).cast("decimal(12,2)")
    return {
        **stg,
        "Stg_Customer": stg["Stg_Customer"].withColumns({
            "CustomerId": F.when(key % 10 == 1, key + 100_000).otherwise(key),
            "ContactName": F.when(key % 5 == 2, long_name).otherwise(c("ContactName"))}),
        "Stg_StockItem": stg["Stg_StockItem"].withColumns({
            "Cost": box("Cost"), "RetailPrice": F.when(c("StockItemId") % 3 == 0, box("RetailPrice")).otherwise(
                c("RetailPrice").cast("decimal(12,2)"))}),
    }
