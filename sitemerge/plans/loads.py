"""The eleven loads as data: their update statements and insert arms.

Each load brings one ODS table up to date from the staging tables of both
sites: first its updates (``U-*``, in order, each seeing the previous one's
result), then one insert of all its arms (``N-*``), each arm anti-joined
against the state after the updates.  The arms and updates are plain
DataFrame expressions over a :class:`Ctx`; :mod:`sitemerge.plans.pipeline`
runs them.

Every arm also carries ``_n``, the numeric key of the staging row it came
from; the run drops it before the union, the test fixtures use it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import (
    concat_null_empty,
    discontinued_from_active,
    termination_from_active,
    text_key,
    typed_null,
)
from ..operators.joins import gate, lookup, new_rows
from ..operators.upsert import UpdateSpec, track
from ..sources.targets import TABLES

DEFAULT_LOAD_TS = "2024-11-24 00:00:00"


@dataclass
class Options:
    """``strict=False`` reproduces the loads as written (the default);
    ``strict=True`` repairs the findings that make re-runs unsafe:
    NULL address texts are not inserted again and again, and change tests
    compare after the narrowing cast the target applies.
    ``collation`` names a Spark collation for text join keys (None: bytes).
    ``buckets`` publishes each state bucketed by its source key, so the next
    run joins it on that key without shuffling it.
    ``rejects`` keeps rows that a target column can't hold out of a store's tables and
    reports them (runs on a store only)."""

    strict: bool = False
    collation: str | None = None
    buckets: int | None = None  # publish states bucketed by their source key
    rejects: bool = False  # report rows that don't fit instead of storing them


@dataclass
class Ctx:
    spark: SparkSession
    stg: dict[str, DataFrame]
    state: dict[str, DataFrame]
    load_ts: Column
    options: Options = field(default_factory=Options)
    empty: frozenset = frozenset()  # tables known to be empty (first run)

    def key(self, c) -> Column:
        return text_key(c, self.options.collation)


def site_keys(ctx: Ctx, keys: list, src_site: str, tgt_site: str) -> list:
    """Match keys of a two-site table: the source key alone as the loads
    compare it, plus the site tag in strict mode (ids of the two sites may
    coincide)."""
    return keys + [(src_site, tgt_site)] if ctx.options.strict else keys


def ts_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


@dataclass(frozen=True)
class Arm:
    name: str
    build: Callable[[Ctx, DataFrame | None], DataFrame]


@dataclass(frozen=True)
class Load:
    table: str
    updates: list[Callable[[Ctx], UpdateSpec]]
    arms: list[Arm]


def _audit(ctx: Ctx, last_update: Column | None = None) -> list[Column]:
    return [
        ctx.load_ts.alias("date_created"),
        (last_update if last_update is not None else typed_null("timestamp_ntz")).alias(
            "last_update"
        ),
    ]


def _num(c: str) -> Column:
    return F.col(c).cast("long").alias("_n")


def _num_text(c: str) -> Column:
    return F.col(c).try_cast("long").alias("_n")


# --------------------------------------------------------------------------- site

# The two source systems as the site load declares them.
SITES = [(1, "SouthwindSales"), (2, "NW_Traders_Sales")]


def _site_arm(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    rows = ctx.spark.createDataFrame(SITES, "site_id short, name string")
    rows = new_rows(rows, tgt, [("site_id", "site_id")])
    return rows.select("site_id", "name", *_audit(ctx), _num("site_id"))


# --------------------------------------------------------------------------- region


def _u_region(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_region",
        ctx.stg["Stg_Region"],
        [("RegionID", "orig_region_id")],
        [track("description", "RegionDescription", "text")],
    )


def _n_region(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Region"], tgt, [("RegionID", "orig_region_id")])
    return src.select(
        F.col("RegionID").alias("orig_region_id"),
        F.col("RegionDescription").alias("description"),
        *_audit(ctx),
        _num("RegionID"),
    )


# --------------------------------------------------------------------------- address


def _full(ctx: Ctx) -> Column:
    return concat_null_empty("AddressLine1", F.lit(" "), "AddressLine2")


def _u_address(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_address",
        ctx.stg["Stg_Address"],
        site_keys(ctx, [("AddressId", "orig_address_id")], "RecordOrigSiteId", "site_id"),
        [
            track("full_address", _full(ctx), "text"),
            track("city", "City", "text"),
            track("state", "State", "text"),
            track("postal_code", "ZipCode", "text"),
        ],
        null_keys=True,
    )


def _n_address_a(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Address"], tgt, site_keys(ctx, [("AddressId", "orig_address_id")], "RecordOrigSiteId", "site_id"))
    return src.select(
        F.col("AddressId").alias("orig_address_id"),
        _full(ctx).alias("full_address"),
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("ZipCode").alias("postal_code"),
        typed_null("string").alias("country"),
        *_audit(ctx),
        F.col("RecordOrigSiteId").alias("site_id"),
        _num("AddressId"),
    )


def _address_text_arm(table, addr, city, state, postal, country, key, by_country=False):
    def build(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
        src = ctx.stg[table]
        if ctx.options.strict or table == "Stg_Employees":
            # the employee arm filters NULL texts; strict mode does so everywhere
            src = src.where(F.col(addr).isNotNull())
        on = [(ctx.key(addr), "full_address")]
        if by_country:
            on.append((country, "country"))
        order = [_num_text(key) if table == "Stg_Customers" else _num(key)]
        if tgt is not None:
            # few distinct addresses among many rows: reduced map-side before
            # the join on a text key (rows keep no source key from here on)
            src = src.select("SiteId", addr, city, state, postal, country).distinct()
            order = []
        src = new_rows(src, tgt, on)
        return src.select(
            typed_null("long").alias("orig_address_id"),
            F.col(addr).alias("full_address"),
            F.col(city).alias("city"),
            F.col(state).alias("state"),
            F.col(postal).alias("postal_code"),
            F.col(country).alias("country"),
            *_audit(ctx),
            F.col("SiteId").alias("site_id"),
            *order,
        )

    return build


# --------------------------------------------------------------------------- customer


def _u_customer_1(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_customer_1",
        ctx.stg["Stg_Customer"],
        site_keys(ctx, [(F.col("CustomerId").cast("string"), "orig_customer_id")], "RecordOrigSiteId", "record_orig_site_id"),
        [
            track("company_name", "CustomerName", "text"),
            track("contact_name", "ContactName", "text"),
            track("phone", "PhoneNumber", "text"),
        ],
    )


def _u_customer_2(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_customer_2",
        ctx.stg["Stg_Customers"],
        site_keys(ctx, [("CustomerID", "orig_customer_id")], "SiteId", "record_orig_site_id"),
        [
            track("company_name", "CompanyName", "text"),
            track("contact_name", "ContactName", "text"),
            track("contact_job_title", "ContactTitle", "text"),
            track("phone", "Phone", "text"),
        ],
    )


def _n_customer_1(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(
        ctx.stg["Stg_Customer"], tgt,
        site_keys(ctx, [(F.col("CustomerId").cast("string"), "orig_customer_id")],
                  "RecordOrigSiteId", "record_orig_site_id"),
    )
    stg_addr = ctx.stg["Stg_Address"]
    src = lookup(src, stg_addr, [("BillingAddressId", "AddressId")],
                 {"_b1": "AddressLine1", "_b2": "AddressLine2"})
    src = lookup(src, stg_addr, [("DeliveryAddressId", "AddressId")],
                 {"_d1": "AddressLine1", "_d2": "AddressLine2"})
    site1 = ctx.state["address"].where(F.col("site_id") == 1)
    one = ctx.options.strict  # strict: the lowest id when a text matches several
    src = lookup(src, site1, [(ctx.key(concat_null_empty("_b1", F.lit(" "), "_b2")), "full_address")],
                 {"_bill": "ODS_address_id"}, lowest=one)
    src = lookup(src, site1, [(ctx.key(concat_null_empty("_d1", F.lit(" "), "_d2")), "full_address")],
                 {"_deliv": "ODS_address_id"}, lowest=one)
    return src.select(
        F.col("CustomerId").cast("string").alias("orig_customer_id"),
        F.col("CustomerName").alias("company_name"),
        F.col("ContactName").alias("contact_name"),
        typed_null("string").alias("contact_job_title"),
        F.col("PhoneNumber").alias("phone"),
        F.col("_bill").alias("ODS_address_id"),
        F.col("_deliv").alias("ODS_delivery_address_id"),
        *_audit(ctx),
        F.col("RecordOrigSiteId").alias("record_orig_site_id"),
        _num("CustomerId"),
    )


def _n_customer_2(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Customers"], tgt, site_keys(ctx, [("CustomerID", "orig_customer_id")], "SiteId", "record_orig_site_id"))
    site2 = ctx.state["address"].where(F.col("site_id") == 2)
    # LEFT JOIN address ... WHERE address.site_id = 2: an inner lookup
    src = lookup(src, site2, [(ctx.key("Address"), "full_address")], {"_addr": "ODS_address_id"},
                 how="inner", lowest=ctx.options.strict)
    return src.select(
        F.col("CustomerID").alias("orig_customer_id"),
        F.col("CompanyName").alias("company_name"),
        F.col("ContactName").alias("contact_name"),
        F.col("ContactTitle").alias("contact_job_title"),
        F.col("Phone").alias("phone"),
        F.col("_addr").alias("ODS_address_id"),
        F.col("_addr").alias("ODS_delivery_address_id"),
        *_audit(ctx),
        F.col("SiteId").alias("record_orig_site_id"),
        _num_text("CustomerID"),
    )


# --------------------------------------------------------------------------- employee


def _u_employee_1(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_employee_1",
        ctx.stg["Stg_SalesPerson"],
        site_keys(ctx, [("SalesPersonId", "orig_employee_id")], "RecordOrigSiteId", "record_orig_site_id"),
        [
            track("first_name", "FirstName", "text"),
            track("last_name", "LastName", "text"),
            track("phone", "PhoneNumber", "text"),
            track("email", "Email", "text"),
        ],
    )


def _u_employee_2(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_employee_2",
        ctx.stg["Stg_Employees"],
        site_keys(ctx, [("EmployeeID", "orig_employee_id")], "SiteId", "record_orig_site_id"),
        [
            track("first_name", "FirstName", "text"),
            track("last_name", "LastName", "text"),
            track("job_title", "JobTitle", "text"),
            track("birth_date", "BirthDate", "date"),
            track("hire_date", "HireDate", "date"),
            track("termination_date", "TerminationDate", "date"),
            track("phone", "HomePhone", "text"),
            track("email", "EmailAddress", "text"),
            # int source against a text column: both compared as text
            track("reports_to", F.col("ReportsTo").cast("string"), "text"),
            track("notes", "Notes", "text"),
        ],
    )


def _n_employee_1(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_SalesPerson"], tgt, site_keys(ctx, [("SalesPersonId", "orig_employee_id")], "RecordOrigSiteId", "record_orig_site_id"))
    return src.select(
        F.col("SalesPersonId").alias("orig_employee_id"),
        F.col("FirstName").alias("first_name"),
        F.col("LastName").alias("last_name"),
        typed_null("string").alias("job_title"),
        typed_null("timestamp_ntz").alias("birth_date"),
        typed_null("timestamp_ntz").alias("hire_date"),
        termination_from_active("IsActive", ctx.load_ts).alias("termination_date"),
        F.col("PhoneNumber").alias("phone"),
        typed_null("long").alias("ODS_address_id"),
        F.col("Email").alias("email"),
        typed_null("string").alias("reports_to"),
        typed_null("string").alias("notes"),
        *_audit(ctx),
        F.col("RecordOrigSiteId").alias("record_orig_site_id"),
        _num("SalesPersonId"),
    )


def _n_employee_2(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Employees"], tgt, site_keys(ctx, [("EmployeeID", "orig_employee_id")], "SiteId", "record_orig_site_id"))
    src = lookup(src, ctx.state["address"], [(ctx.key("Address"), "full_address")],
                 {"_addr": "ODS_address_id"}, lowest=ctx.options.strict)
    return src.select(
        F.col("EmployeeID").alias("orig_employee_id"),
        F.col("FirstName").alias("first_name"),
        F.col("LastName").alias("last_name"),
        F.col("JobTitle").alias("job_title"),
        F.col("BirthDate").alias("birth_date"),
        F.col("HireDate").alias("hire_date"),
        F.col("TerminationDate").alias("termination_date"),
        F.col("HomePhone").alias("phone"),
        F.col("_addr").alias("ODS_address_id"),
        F.col("EmailAddress").alias("email"),
        F.col("ReportsTo").cast("string").alias("reports_to"),
        F.col("Notes").alias("notes"),
        *_audit(ctx),
        F.col("SiteId").alias("record_orig_site_id"),
        _num("EmployeeID"),
    )


# --------------------------------------------------------------------------- supplier


def _u_supplier_1(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_supplier_1",
        ctx.stg["Stg_Supplier"],
        site_keys(ctx, [("SupplierId", "orig_supplier_id")], "SiteId", "site_id"),
        [
            track("company_name", "SupplierName", "text"),
            track("contact_name", "ContactName", "text"),
            track("phone", "PhoneNumber", "text"),
            track("website", "Website", "text"),
        ],
    )


def _u_supplier_2(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_supplier_2",
        ctx.stg["Stg_Suppliers"],
        site_keys(ctx, [("SupplierID", "orig_supplier_id")], "SiteId", "site_id"),
        [
            track("company_name", "CompanyName", "text"),
            track("contact_name", "ContactName", "text"),
            track("contact_job_title", "ContactTitle", "text"),
            track("phone", "Phone", "text"),
        ],
    )


def _n_supplier_1(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Supplier"], tgt, site_keys(ctx, [("SupplierId", "orig_supplier_id")], "SiteId", "site_id"))
    src = lookup(src, ctx.state["address"], [("AddressId", "orig_address_id")],
                 {"_addr": "ODS_address_id"})
    return src.select(
        F.col("SupplierId").alias("orig_supplier_id"),
        F.col("SupplierName").alias("company_name"),
        F.col("ContactName").alias("contact_name"),
        typed_null("string").alias("contact_job_title"),
        F.col("PhoneNumber").alias("phone"),
        F.col("Website").alias("website"),
        F.col("_addr").alias("ODS_address_id"),
        *_audit(ctx),
        F.col("SiteId").alias("site_id"),
        _num("SupplierId"),
    )


def _n_supplier_2(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Suppliers"], tgt, site_keys(ctx, [("SupplierID", "orig_supplier_id")], "SiteId", "site_id"))
    src = lookup(src, ctx.state["address"], [(ctx.key("Address"), "full_address")],
                 {"_addr": "ODS_address_id"}, lowest=ctx.options.strict)
    return src.select(
        F.col("SupplierID").alias("orig_supplier_id"),
        F.col("CompanyName").alias("company_name"),
        F.col("ContactName").alias("contact_name"),
        F.col("ContactTitle").alias("contact_job_title"),
        F.col("Phone").alias("phone"),
        typed_null("string").alias("website"),
        F.col("_addr").alias("ODS_address_id"),
        *_audit(ctx),
        F.col("SiteId").alias("site_id"),
        _num("SupplierID"),
    )


# --------------------------------------------------------------------------- territory


def _u_territory(ctx: Ctx) -> UpdateSpec:
    return UpdateSpec(
        "u_territory",
        ctx.stg["Stg_Territories"],
        [("TerritoryID", "orig_territory_id")],
        [track("description", "TerritoryDescription", "text")],
    )


def _n_territory(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    src = new_rows(ctx.stg["Stg_Territories"], tgt, [("TerritoryID", "orig_territory_id")])
    src = lookup(src, ctx.state["region"], [("RegionID", "orig_region_id")],
                 {"_region": "ODS_region_id"}, small=True)
    return src.select(
        F.col("TerritoryID").alias("orig_territory_id"),
        F.col("TerritoryDescription").alias("description"),
        F.col("_region").alias("ODS_region_id"),
        *_audit(ctx),
        F.col("SiteId").alias("record_orig_site_id"),
        _num_text("TerritoryID"),
    )


# --------------------------------------------------------------------------- employee_territory


def employee_territory_candidates(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    """Resolved pairs before the NULL-key rejection (Q-PK reads these)."""
    src = ctx.stg["Stg_EmployeeTerritories"]
    emp2 = ctx.state["employee"].where(F.col("record_orig_site_id") == 2)
    src = lookup(src, emp2, [("EmployeeID", "orig_employee_id")], {"_emp": "ODS_employee_id"},
                 how="inner", small=True)
    src = lookup(src, ctx.state["territory"], [("TerritoryID", "orig_territory_id")],
                 {"_terr": "ODS_territory_id"}, small=True)
    src = new_rows(src, tgt, [("_emp", "ODS_employee_id"), ("_terr", "ODS_territory_id")])
    return src.select(
        F.col("_emp").alias("ODS_employee_id"),
        F.col("_terr").alias("ODS_territory_id"),
        ctx.load_ts.alias("date_created"),
        _num("EmployeeID"),
    )


def _n_employee_territory(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    # A pair with an unknown territory has a NULL primary-key part; the
    # database would reject the whole statement.  Here such rows are left
    # out and reported by quality.check_pk on the candidates.
    cand = employee_territory_candidates(ctx, tgt)
    return cand.where(F.col("ODS_employee_id").isNotNull() & F.col("ODS_territory_id").isNotNull())


# --------------------------------------------------------------------------- product


def _site_suppliers(ctx: Ctx, site: int) -> DataFrame:
    return ctx.state["supplier"].where(F.col("site_id") == site)


def _qty_outer_text() -> Column:
    return F.col("QuantityPerOuter").cast("string")


def _u_product_1(ctx: Ctx) -> UpdateSpec:
    stg = ctx.stg
    src = stg["Stg_StockItem"]
    src = lookup(src, stg["Stg_StockItemInventory"], [("StockItemId", "StockItemID")],
                 {"_qoh": "QuantityOnHand", "_reorder": "ReorderLevel",
                  "_target": "TargetStockLevel", "_bin": "BinLocation"}, how="inner")
    src = lookup(src, stg["Stg_ItemCategory"], [("ItemCategoryId", "CategoryId")],
                 {"_category": "Category"}, small=True, how="inner")
    src = gate(src, _site_suppliers(ctx, 1), [("SupplierId", "orig_supplier_id")], small=True)
    if ctx.options.strict:
        qty_cmp = F.coalesce(_qty_outer_text(), F.lit(""))
    else:
        # ISNULL(int, '') reads '' as 0, so a NULL quantity compares as '0'
        qty_cmp = F.coalesce(F.col("QuantityPerOuter"), F.lit(0)).cast("string")
    return UpdateSpec(
        "u_product_1",
        src,
        site_keys(ctx, [("StockItemId", "orig_product_id")], "SiteId", "site_id"),
        [
            track("name", "StockItemName", "text"),
            track("category_name", "_category", "text"),
            track("color", "Color", "text"),
            track("size", "Size", "text"),
            track("quantity_per_unit", _qty_outer_text(), "text", src_cmp=qty_cmp),
            track("unit_price", "Cost", "price"),
            track("wholesale_price", "RetailPrice", "price"),
            track("units_in_stock", "_qoh", "count"),
            track("reorder_level", "_reorder", "count"),
            track("target_stock_level", "_target", "count"),
            track("bin_location", "_bin", "text"),
            track("discontinued", discontinued_from_active("IsActive"), "flag",
                  src_cmp=discontinued_from_active("IsActive")),
        ],
    )


def _u_product_2(ctx: Ctx) -> UpdateSpec:
    stg = ctx.stg
    src = lookup(stg["Stg_Products"], stg["Stg_Categories"], [("CategoryID", "CategoryID")],
                 {"_cat_name": "CategoryName", "_cat_desc": "Description"}, small=True, how="inner")
    src = gate(src, _site_suppliers(ctx, 2), [("SupplierID", "orig_supplier_id")], small=True)
    return UpdateSpec(
        "u_product_2",
        src,
        site_keys(ctx, [("ProductID", "orig_product_id")], "SiteId", "site_id"),
        [
            track("name", "ProductName", "text"),
            track("category_name", "_cat_name", "text"),
            track("category_description", "_cat_desc", "text"),
            track("quantity_per_unit", "QuantityPerUnit", "text"),
            track("unit_price", "UnitPrice", "price"),
            track("wholesale_price", "WholesalePrice", "price"),
            track("units_in_stock", "UnitsInStock", "count"),
            track("units_on_order", "UnitsOnOrder", "count"),
            track("reorder_level", "ReorderLevel", "count"),
            track("discontinued", "Discontinued", "flag"),
        ],
    )


def _n_product_1(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    stg = ctx.stg
    src = new_rows(stg["Stg_StockItem"], tgt, site_keys(ctx, [("StockItemId", "orig_product_id")], "SiteId", "site_id"))
    src = lookup(src, stg["Stg_StockItemInventory"], [("StockItemId", "StockItemID")],
                 {"_qoh": "QuantityOnHand", "_reorder": "ReorderLevel",
                  "_target": "TargetStockLevel", "_bin": "BinLocation",
                  "_edited": "LastEditDateTime"})
    src = lookup(src, stg["Stg_ItemCategory"], [("ItemCategoryId", "CategoryId")],
                 {"_category": "Category"}, small=True)
    src = lookup(src, _site_suppliers(ctx, 1), [("SupplierId", "orig_supplier_id")],
                 {"_supplier": "ODS_supplier_id"}, how="inner", small=True)
    return src.select(
        F.col("StockItemId").alias("orig_product_id"),
        F.col("StockItemName").alias("name"),
        F.col("_category").alias("category_name"),
        typed_null("string").alias("category_description"),
        F.col("_supplier").alias("ODS_supplier_id"),
        F.col("Color").alias("color"),
        F.col("Size").alias("size"),
        _qty_outer_text().alias("quantity_per_unit"),
        F.col("Cost").alias("unit_price"),
        F.col("RetailPrice").alias("wholesale_price"),
        F.col("_qoh").alias("units_in_stock"),
        typed_null("int").alias("units_on_order"),
        F.col("_reorder").alias("reorder_level"),
        F.col("_target").alias("target_stock_level"),
        F.col("_bin").alias("bin_location"),
        discontinued_from_active("IsActive").alias("discontinued"),
        # site 1 fills last_update from the inventory's edit time
        *_audit(ctx, F.col("_edited")),
        F.col("SiteId").alias("site_id"),
        _num("StockItemId"),
    )


def _n_product_2(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    stg = ctx.stg
    src = new_rows(stg["Stg_Products"], tgt, site_keys(ctx, [("ProductID", "orig_product_id")], "SiteId", "site_id"))
    src = lookup(src, stg["Stg_Categories"], [("CategoryID", "CategoryID")],
                 {"_cat_name": "CategoryName", "_cat_desc": "Description"}, small=True)
    src = lookup(src, _site_suppliers(ctx, 2), [("SupplierID", "orig_supplier_id")],
                 {"_supplier": "ODS_supplier_id"}, how="inner", small=True)
    return src.select(
        F.col("ProductID").alias("orig_product_id"),
        F.col("ProductName").alias("name"),
        F.col("_cat_name").alias("category_name"),
        F.col("_cat_desc").alias("category_description"),
        F.col("_supplier").alias("ODS_supplier_id"),
        typed_null("string").alias("color"),
        typed_null("string").alias("size"),
        F.col("QuantityPerUnit").alias("quantity_per_unit"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("WholesalePrice").alias("wholesale_price"),
        F.col("UnitsInStock").alias("units_in_stock"),
        F.col("UnitsOnOrder").alias("units_on_order"),
        F.col("ReorderLevel").alias("reorder_level"),
        typed_null("int").alias("target_stock_level"),
        typed_null("string").alias("bin_location"),
        F.col("Discontinued").alias("discontinued"),
        *_audit(ctx),
        F.col("SiteId").alias("site_id"),
        _num("ProductID"),
    )


# --------------------------------------------------------------------------- order


def _u_order_1(ctx: Ctx) -> UpdateSpec:
    emp1 = ctx.state["employee"].where(F.col("record_orig_site_id") == 1)
    src = gate(ctx.stg["Stg_OrderHeader"], emp1, [("SalesPersonId", "orig_employee_id")], small=True)
    return UpdateSpec(
        "u_order_1",
        src,
        site_keys(ctx, [("OrderId", "orig_order_id")], "SiteId", "site_id"),
        [
            track("order_date", "OrderDate", "date"),
            track("ship_date", "ShipDate", "date"),
            track("order_number", "CustomerPurchaseOrderNumber", "text"),
        ],
    )


def _u_order_2(ctx: Ctx) -> UpdateSpec:
    src = lookup(ctx.stg["Stg_Orders"], ctx.stg["Stg_Shippers"], [("ShipVia", "ShipperID")],
                 {"_ship_name": "CompanyName", "_ship_phone": "Phone"}, small=True, how="inner")
    src = gate(src, ctx.state["employee"],
               site_keys(ctx, [("EmployeeID", "orig_employee_id")], "SiteId", "record_orig_site_id"), small=True)
    src = gate(src, ctx.state["address"],
               [(ctx.key("ShipAddress"), "full_address"), ("ShipCountry", "country")])
    return UpdateSpec(
        "u_order_2",
        src,
        site_keys(ctx, [("OrderID", "orig_order_id")], "SiteId", "site_id"),
        [
            track("order_date", "OrderDate", "date"),
            track("required_date", "RequiredDate", "date"),
            track("ship_via", "_ship_name", "text"),
            track("shipping_company_phone", "_ship_phone", "text"),
            track("freight", "Freight", "price"),
        ],
    )


def _n_order_1(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    stg, state = ctx.stg, ctx.state
    src = new_rows(stg["Stg_OrderHeader"], tgt, site_keys(ctx, [("OrderId", "orig_order_id")], "SiteId", "site_id"),
                   hashed=True)
    src = lookup(src, state["customer"],
                 site_keys(ctx, [(F.col("CustomerId").cast("string"), "orig_customer_id")],
                           "SiteId", "record_orig_site_id"),
                 {"_cust": "ODS_customer_id"}, hashed=True)
    emp1 = state["employee"].where(F.col("record_orig_site_id") == 1)
    src = lookup(src, emp1, [("SalesPersonId", "orig_employee_id")], {"_emp": "ODS_employee_id"},
                 how="inner", small=True)
    # three hops: order -> staging customer -> staging address -> ODS address
    src = lookup(src, stg["Stg_Customer"], [("CustomerId", "CustomerId")],
                 {"_deliv_src": "DeliveryAddressId"}, hashed=True)
    src = lookup(src, stg["Stg_Address"], [("_deliv_src", "AddressId")], {"_deliv_addr": "AddressId"}, hashed=True)
    src = lookup(src, state["address"], [("_deliv_addr", "orig_address_id")],
                 {"_addr": "ODS_address_id"}, hashed=True)
    return src.select(
        F.col("OrderId").alias("orig_order_id"),
        F.col("_cust").alias("ODS_customer_id"),
        F.col("_emp").alias("ODS_employee_id"),
        F.col("_addr").alias("ODS_address_id"),
        F.col("OrderDate").alias("order_date"),
        F.col("ShipDate").alias("ship_date"),
        typed_null("timestamp_ntz").alias("required_date"),
        F.col("CustomerPurchaseOrderNumber").alias("order_number"),
        typed_null("string").alias("ship_via"),
        typed_null("string").alias("shipping_company_phone"),
        typed_null("decimal(19,4)").alias("freight"),
        *_audit(ctx),
        F.col("SiteId").alias("site_id"),
        _num("OrderId"),
    )


def _n_order_2(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
    stg, state = ctx.stg, ctx.state
    src = new_rows(stg["Stg_Orders"], tgt, site_keys(ctx, [("OrderID", "orig_order_id")], "SiteId", "site_id"),
                   hashed=True)
    src = lookup(src, stg["Stg_Shippers"], [("ShipVia", "ShipperID")],
                 {"_ship_name": "CompanyName", "_ship_phone": "Phone"}, small=True)
    src = lookup(src, state["customer"],
                 site_keys(ctx, [("CustomerID", "orig_customer_id")], "SiteId", "record_orig_site_id"),
                 {"_cust": "ODS_customer_id"}, hashed=True)
    emp2 = state["employee"].where(F.col("record_orig_site_id") == 2)
    src = lookup(src, emp2, [("EmployeeID", "orig_employee_id")], {"_emp": "ODS_employee_id"},
                 how="inner", small=True)
    src = lookup(src, state["address"],
                 [(ctx.key("ShipAddress"), "full_address"), ("ShipCountry", "country")],
                 {"_addr": "ODS_address_id"}, lowest=ctx.options.strict)
    return src.select(
        F.col("OrderID").alias("orig_order_id"),
        F.col("_cust").alias("ODS_customer_id"),
        F.col("_emp").alias("ODS_employee_id"),
        F.col("_addr").alias("ODS_address_id"),
        F.col("OrderDate").alias("order_date"),
        typed_null("timestamp_ntz").alias("ship_date"),
        F.col("RequiredDate").alias("required_date"),
        typed_null("string").alias("order_number"),
        F.col("_ship_name").alias("ship_via"),
        F.col("_ship_phone").alias("shipping_company_phone"),
        F.col("Freight").alias("freight"),
        *_audit(ctx),
        F.col("SiteId").alias("site_id"),
        _num("OrderID"),
    )


# --------------------------------------------------------------------------- order_detail


def _gate_order_product(ctx: Ctx, src: DataFrame, order_col: str, product_col: str) -> DataFrame:
    src = gate(src, ctx.state["order"], [(order_col, "orig_order_id"), ("SiteId", "site_id")], hashed=True)
    return gate(src, ctx.state["product"], [(product_col, "orig_product_id"), ("SiteId", "site_id")], hashed=True)


# Line keys of the order-line staging tables in strict mode: site 1 lines by
# their line id, site 2 lines (whose "line id" is the order id) by order and
# product.
_STRICT_LINE_KEYS = {
    "Stg_OrderLine": ["OrderLineId", "SiteId"],
    "Stg_OrderDetails": ["OrderID", "SiteId", "ProductID"],
}


def _lines(ctx: Ctx, driver: str) -> DataFrame:
    """The order-line staging rows; in strict mode first reduced to one row
    per line key (the smallest tuple of the other columns, NULLs first), so
    the update and the insert see the same single row of a line."""
    df = ctx.stg[driver]
    if not ctx.options.strict:
        return df
    keys = _STRICT_LINE_KEYS[driver]
    return _one_per_key(df, keys, [c for c in df.columns if c not in keys])


def _one_per_key(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The smallest value tuple per key (NULLs first): a partial aggregation."""
    return df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_m")).select(*keys, "_m.*")


def _u_order_detail_1(ctx: Ctx) -> UpdateSpec:
    src = _gate_order_product(ctx, _lines(ctx, "Stg_OrderLine"), "OrderId", "StockItemId")
    return UpdateSpec(
        "u_order_detail_1",
        src,
        site_keys(ctx, [("OrderLineId", "orig_order_detail_id")], "SiteId", "site_id"),
        _od_tracks(ctx, [("quantity_per_unit", "Quantity", "count"),
                         ("unit_price", "UnitPrice", "price"),
                         ("tax_rate", "TaxRate", "count"),
                         ("item_picked_date", "ItemPickedDate", "date")]),
        repeats=True,
        joined=True,
    )


def _u_order_detail_2(ctx: Ctx) -> UpdateSpec:
    items = [("quantity_per_unit", "Quantity", "count"), ("unit_price", "UnitPrice", "price"),
             ("discount", "Discount", "count")]
    src = _lines(ctx, "Stg_OrderDetails")
    if ctx.options.strict:
        # strict: a line is (order, site, product)
        src = gate(src, ctx.state["order"], [("OrderID", "orig_order_id"), ("SiteId", "site_id")])
        src = lookup(src, ctx.state["product"], [("ProductID", "orig_product_id"), ("SiteId", "site_id")],
                     {"_product": "ODS_product_id"}, how="inner", lowest=True)
        match = [("OrderID", "orig_order_detail_id"), ("SiteId", "site_id"), ("_product", "ODS_product_id")]
    else:
        src = _gate_order_product(ctx, src, "OrderID", "ProductID")
        match = [("OrderID", "orig_order_detail_id")]
    return UpdateSpec("u_order_detail_2", src, match, _od_tracks(ctx, items), repeats=True, joined=True)


def _od_tracks(ctx: Ctx, items) -> list:
    out = []
    for target, source, kind in items:
        if ctx.options.strict:
            # compare what would be stored: decimal(18,0) rounds the fraction off
            dtype = TABLES["order_detail"].col(target).dtype
            out.append(track(target, source, kind,
                             src_cmp=F.coalesce(F.col(source).cast(dtype),
                                                F.lit(-1 if kind == "price" else 0).cast(dtype))
                             if kind != "date" else None))
        else:
            out.append(track(target, source, kind))
    return out


def _order_detail_arm(driver, line_key, order_col, product_col, tax, picked, discount):
    def build(ctx: Ctx, tgt: DataFrame | None) -> DataFrame:
        # strict site 2: a line is (order, site, product), matched after the lookup
        by_product = ctx.options.strict and driver == "Stg_OrderDetails"
        src = _lines(ctx, driver)
        if not by_product:
            src = new_rows(src, tgt,
                           site_keys(ctx, [(line_key, "orig_order_detail_id")], "SiteId", "site_id"), hashed=True)
        src = lookup(src, ctx.state["order"], [(order_col, "orig_order_id"), ("SiteId", "site_id")],
                     {"_order": "ODS_order_id"}, lowest=ctx.options.strict, hashed=True)
        src = lookup(src, ctx.state["product"],
                     [(product_col, "orig_product_id"), ("SiteId", "site_id")],
                     {"_product": "ODS_product_id"}, lowest=ctx.options.strict, hashed=True)
        if by_product:
            # an unresolved product still names the line: NULL matches NULL
            src = new_rows(src, tgt, [(line_key, "orig_order_detail_id"), ("SiteId", "site_id"),
                                      ("_product", "ODS_product_id", "null_safe")])
        return src.select(
            F.col(line_key).alias("orig_order_detail_id"),
            F.col("_order").alias("ODS_order_id"),
            F.col("_product").alias("ODS_product_id"),
            F.col("Quantity").alias("quantity_per_unit"),
            F.col("UnitPrice").alias("unit_price"),
            (F.col(tax) if tax else typed_null("decimal(5,2)")).alias("tax_rate"),
            (F.col(picked) if picked else typed_null("timestamp_ntz")).alias("item_picked_date"),
            (F.col(discount) if discount else typed_null("decimal(5,2)")).alias("discount"),
            *_audit(ctx),
            F.col("SiteId").alias("site_id"),
            _num(order_col),
        )

    return build


# Staging keys of the loads whose updates and arms match the own table on its
# source key only (address arms match texts, employee territories id pairs).
STAGED_KEYS: dict[str, list[tuple[str, str]]] = {
    "region": [("Stg_Region", "RegionID")],
    "customer": [("Stg_Customer", "cast(CustomerId as string)"), ("Stg_Customers", "CustomerID")],
    "employee": [("Stg_SalesPerson", "SalesPersonId"), ("Stg_Employees", "EmployeeID")],
    "supplier": [("Stg_Supplier", "SupplierId"), ("Stg_Suppliers", "SupplierID")],
    "territory": [("Stg_Territories", "TerritoryID")],
    "product": [("Stg_StockItem", "StockItemId"), ("Stg_Products", "ProductID")],
    "order": [("Stg_OrderHeader", "OrderId"), ("Stg_Orders", "OrderID")],
    "order_detail": [("Stg_OrderLine", "OrderLineId"), ("Stg_OrderDetails", "OrderID")],
}


# --------------------------------------------------------------------------- registry

LOADS: dict[str, Load] = {
    "site": Load("site", [], [Arm("site", _site_arm)]),
    "region": Load("region", [_u_region], [Arm("region", _n_region)]),
    "address": Load(
        "address",
        [_u_address],
        [
            Arm("address_a", _n_address_a),
            Arm("address_b", _address_text_arm("Stg_Customers", "Address", "City", "Region",
                                               "PostalCode", "Country", "CustomerID")),
            Arm("address_c", _address_text_arm("Stg_Employees", "Address", "City",
                                               "StateOrRegion", "PostalCode", "Country",
                                               "EmployeeID")),
            Arm("address_d", _address_text_arm("Stg_Suppliers", "Address", "City",
                                               "StateOrRegion", "PostalCode", "Country",
                                               "SupplierID")),
            Arm("address_e", _address_text_arm("Stg_Orders", "ShipAddress", "ShipCity",
                                               "ShipStateOrRegion", "ShipPostalCode",
                                               "ShipCountry", "OrderID", by_country=True)),
        ],
    ),
    "customer": Load(
        "customer",
        [_u_customer_1, _u_customer_2],
        [Arm("customer_1", _n_customer_1), Arm("customer_2", _n_customer_2)],
    ),
    "employee": Load(
        "employee",
        [_u_employee_1, _u_employee_2],
        [Arm("employee_1", _n_employee_1), Arm("employee_2", _n_employee_2)],
    ),
    "supplier": Load(
        "supplier",
        [_u_supplier_1, _u_supplier_2],
        [Arm("supplier_1", _n_supplier_1), Arm("supplier_2", _n_supplier_2)],
    ),
    "territory": Load("territory", [_u_territory], [Arm("territory", _n_territory)]),
    "employee_territory": Load(
        "employee_territory", [], [Arm("employee_territory", _n_employee_territory)]
    ),
    "product": Load(
        "product",
        [_u_product_1, _u_product_2],
        [Arm("product_1", _n_product_1), Arm("product_2", _n_product_2)],
    ),
    "order": Load(
        "order",
        [_u_order_1, _u_order_2],
        [Arm("order_1", _n_order_1), Arm("order_2", _n_order_2)],
    ),
    "order_detail": Load(
        "order_detail",
        [_u_order_detail_1, _u_order_detail_2],
        [
            Arm("order_detail_1", _order_detail_arm("Stg_OrderLine", "OrderLineId", "OrderId",
                                                    "StockItemId", "TaxRate", "ItemPickedDate",
                                                    None)),
            Arm("order_detail_2", _order_detail_arm("Stg_OrderDetails", "OrderID", "OrderID",
                                                    "ProductID", None, None, "Discount")),
        ],
    ),
}

ORDER = list(LOADS)
