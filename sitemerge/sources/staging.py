"""Staging tables of the two source systems (SRC-STG).

The loads read twenty ``Stg_*`` tables that the source systems fill.  Their
schemas are declared here so a production run reads them without inference
(``spark.read.schema(s).parquet(p)``): column pruning and predicate pushdown
then reach the scan.  Keys are ``long``: the declared widths of the targets (16
and 32 bits) are judged by ``check_range``, not by the reader.  Site 1 tables
carry the site tag as ``RecordOrigSiteId`` or ``SiteId``; site 2 tables as
``SiteId``; ``Stg_Region`` and the lookup tables carry none.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),  # keys of the source systems, whatever their size
    "string": T.StringType(),
    "ts": T.TimestampNTZType(),
    "bool": T.BooleanType(),
    "dec52": T.DecimalType(5, 2),
    "dec182": T.DecimalType(18, 2),
    "dec194": T.DecimalType(19, 4),
}


def _schema(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


STAGING: dict[str, T.StructType] = {
    # shared
    "Stg_Region": _schema("RegionID long, RegionDescription string"),
    # site 1
    "Stg_Address": _schema(
        "AddressId long, AddressLine1 string, AddressLine2 string, City string, "
        "State string, ZipCode string, RecordOrigSiteId short"
    ),
    "Stg_Customer": _schema(
        "CustomerId long, CustomerName string, ContactName string, PhoneNumber string, "
        "BillingAddressId long, DeliveryAddressId long, RecordOrigSiteId short"
    ),
    "Stg_SalesPerson": _schema(
        "SalesPersonId long, FirstName string, LastName string, PhoneNumber string, "
        "Email string, IsActive short, RecordOrigSiteId short"
    ),
    "Stg_Supplier": _schema(
        "SupplierId long, SupplierName string, ContactName string, PhoneNumber string, "
        "Website string, AddressId long, SiteId short"
    ),
    "Stg_StockItem": _schema(
        "StockItemId long, StockItemName string, ItemCategoryId long, SupplierId long, "
        "Color string, Size string, QuantityPerOuter int, Cost dec52, RetailPrice dec52, "
        "IsActive short, SiteId short"
    ),
    "Stg_StockItemInventory": _schema(
        "StockItemID long, QuantityOnHand int, ReorderLevel int, TargetStockLevel int, "
        "BinLocation string, LastEditDateTime ts"
    ),
    "Stg_ItemCategory": _schema("CategoryId long, Category string"),
    "Stg_OrderHeader": _schema(
        "OrderId long, CustomerId long, SalesPersonId long, OrderDate ts, ShipDate ts, "
        "CustomerPurchaseOrderNumber string, SiteId short"
    ),
    "Stg_OrderLine": _schema(
        "OrderLineId long, OrderId long, StockItemId long, Quantity int, UnitPrice dec182, "
        "TaxRate dec52, ItemPickedDate ts, SiteId short"
    ),
    # site 2
    "Stg_Customers": _schema(
        "CustomerID string, CompanyName string, ContactName string, ContactTitle string, "
        "Phone string, Address string, City string, Region string, PostalCode string, "
        "Country string, SiteId short"
    ),
    "Stg_Employees": _schema(
        "EmployeeID long, FirstName string, LastName string, JobTitle string, "
        "BirthDate ts, HireDate ts, TerminationDate ts, HomePhone string, Address string, "
        "City string, StateOrRegion string, PostalCode string, Country string, "
        "EmailAddress string, ReportsTo long, Notes string, SiteId short"
    ),
    "Stg_Suppliers": _schema(
        "SupplierID long, CompanyName string, ContactName string, ContactTitle string, "
        "Phone string, Address string, City string, StateOrRegion string, "
        "PostalCode string, Country string, SiteId short"
    ),
    "Stg_Territories": _schema(
        "TerritoryID string, TerritoryDescription string, RegionID long, SiteId short"
    ),
    "Stg_EmployeeTerritories": _schema("EmployeeID long, TerritoryID string"),
    "Stg_Products": _schema(
        "ProductID long, ProductName string, CategoryID long, SupplierID long, "
        "QuantityPerUnit string, UnitPrice dec52, WholesalePrice dec52, UnitsInStock int, "
        "UnitsOnOrder int, ReorderLevel int, Discontinued bool, SiteId short"
    ),
    "Stg_Categories": _schema("CategoryID long, CategoryName string, Description string"),
    "Stg_Orders": _schema(
        "OrderID long, CustomerID string, EmployeeID long, OrderDate ts, RequiredDate ts, "
        "ShipVia long, Freight dec194, ShipAddress string, ShipCity string, "
        "ShipStateOrRegion string, ShipPostalCode string, ShipCountry string, SiteId short"
    ),
    "Stg_Shippers": _schema("ShipperID long, CompanyName string, Phone string"),
    "Stg_OrderDetails": _schema(
        "OrderID long, ProductID long, Quantity int, UnitPrice dec182, Discount dec52, SiteId short"
    ),
}


def read_staging(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Scan ``<directory>/<Stg_name>.parquet`` with the declared schemas."""
    return {
        name: spark.read.schema(schema).parquet(os.path.join(directory, f"{name}.parquet"))
        for name, schema in STAGING.items()
    }


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast a staging DataFrame to its declared schema, by column name."""
    schema = STAGING[name]
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
