"""Oracle SQL for the quality reports, over the loaded states ``l_<table>``."""

from __future__ import annotations

from dataclasses import replace

from sitemerge.sources.targets import TABLES

from .rules import INSERTS
from .sql import ORDER, _with, base_ctes, new_rows, q, state_map


def _key_text(cols, alias="") -> str:
    pre = f"{alias}." if alias else ""
    return "concat_ws('|', " + ", ".join(
        f"COALESCE(CAST({pre}{q(c)} AS VARCHAR), 'NULL')" for c in cols) + ")"


def q_pk() -> str:
    parts = []
    for name in ORDER:
        pk = list(TABLES[name].pk)
        any_null = " OR ".join(f"{q(c)} IS NULL" for c in pk)
        parts.append(
            f"SELECT '{name}' AS table_name, {_key_text(pk)} AS key_text, "
            f"CASE WHEN {any_null} THEN 'null' ELSE 'duplicate' END AS problem, "
            f"CAST(COUNT(*) AS BIGINT) AS n FROM l_{name} GROUP BY {', '.join(q(c) for c in pk)} "
            f"HAVING ({any_null}) OR COUNT(*) > 1")
    # pairs of known employees, whether or not their territory is known
    states = {**state_map("employee_territory"), "employee_territory": "p_employee_territory"}
    pair = INSERTS["employee_territory"]["employee_territory"]
    open_ = replace(pair, maps={**pair.maps, "area": replace(pair.maps["area"], needed=False)})
    cand = new_rows("employee_territory", open_, states)
    pk = ["ODS_employee_id", "ODS_territory_id"]
    any_null = " OR ".join(f"{q(c)} IS NULL" for c in pk)
    parts.append(
        f"SELECT 'employee_territory_new' AS table_name, {_key_text(pk)} AS key_text, "
        f"CASE WHEN {any_null} THEN 'null' ELSE 'duplicate' END AS problem, "
        f"CAST(COUNT(*) AS BIGINT) AS n FROM ({cand}) cand GROUP BY ODS_employee_id, ODS_territory_id "
        f"HAVING ({any_null}) OR COUNT(*) > 1")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def q_fk() -> str:
    parts = []
    for name in ORDER:
        for fk in TABLES[name].fks:
            not_null = " AND ".join(f"c.{q(c)} IS NOT NULL" for c in fk.cols)
            match = " AND ".join(f"p.{q(pc)} = c.{q(c)}" for c, pc in zip(fk.cols, fk.parent_cols))
            parts.append(
                f"SELECT '{name}' AS table_name, '{','.join(fk.cols)}' AS fk_cols, "
                f"'{fk.parent}' AS parent, CAST(COUNT(*) AS BIGINT) AS orphans FROM l_{name} c "
                f"WHERE {not_null} AND NOT EXISTS (SELECT 1 FROM l_{fk.parent} p WHERE {match})")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def q_len() -> str:
    parts = []
    for name in ORDER:
        for c in TABLES[name].cols:
            if c.width:
                parts.append(
                    f"SELECT '{name}' AS table_name, '{c.name}' AS column_name, {c.width} AS width, "
                    f"CAST(MAX(length({q(c.name)})) AS INTEGER) AS max_length, "
                    f"CAST(COALESCE(SUM(CASE WHEN length({q(c.name)}) > {c.width} THEN 1 ELSE 0 END), 0)"
                    f" AS BIGINT) AS over_width FROM l_{name}")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


NARROWED = {
    "Stg_Region": [("RegionID", "SMALLINT", "smallint")],
    "Stg_SalesPerson": [("SalesPersonId", "SMALLINT", "smallint")],
    "Stg_Employees": [("EmployeeID", "SMALLINT", "smallint")],
    "Stg_StockItem": [("Cost", "DECIMAL(5,2)", "decimal(5,2)"),
                      ("RetailPrice", "DECIMAL(5,2)", "decimal(5,2)")],
    "Stg_Products": [("UnitPrice", "DECIMAL(5,2)", "decimal(5,2)"),
                     ("WholesalePrice", "DECIMAL(5,2)", "decimal(5,2)")],
    "Stg_Orders": [("Freight", "DECIMAL(19,4)", "decimal(19,4)")],
    "Stg_OrderLine": [("UnitPrice", "DECIMAL(18,0)", "decimal(18,0)"),
                      ("TaxRate", "DECIMAL(18,0)", "decimal(18,0)")],
    "Stg_OrderDetails": [("UnitPrice", "DECIMAL(18,0)", "decimal(18,0)"),
                         ("Discount", "DECIMAL(18,0)", "decimal(18,0)")],
}


def q_range() -> str:
    parts = []
    for src, items in NARROWED.items():
        for col, typ, name in items:
            cast = f"TRY_CAST({col} AS {typ})"
            parts.append(
                f"SELECT '{src}' AS source, '{col}' AS column_name, '{name}' AS target_type, "
                f"CAST(COUNT({col}) AS BIGINT) AS n_values, "
                f"CAST(COALESCE(SUM(CASE WHEN {col} IS NOT NULL AND {cast} IS NULL THEN 1 ELSE 0 END), 0)"
                f" AS BIGINT) AS out_of_range, "
                f"CAST(COALESCE(SUM(CASE WHEN {cast} IS NOT NULL AND {cast} <> {col} THEN 1 ELSE 0 END), 0)"
                f" AS BIGINT) AS rounded FROM {src}")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


CLASH_KEYS = [
    ("customer", "Stg_Customer", "CAST(CustomerId AS VARCHAR)", "Stg_Customers", "CustomerID"),
    ("employee", "Stg_SalesPerson", "SalesPersonId", "Stg_Employees", "EmployeeID"),
    ("supplier", "Stg_Supplier", "SupplierId", "Stg_Suppliers", "SupplierID"),
    ("product", "Stg_StockItem", "StockItemId", "Stg_Products", "ProductID"),
    ("order", "Stg_OrderHeader", "OrderId", "Stg_Orders", "OrderID"),
    ("order_detail", "Stg_OrderLine", "OrderLineId", "Stg_OrderDetails", "OrderID"),
]


def q_clash() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS clashes FROM "
        f"(SELECT DISTINCT CAST({k1} AS VARCHAR) AS k FROM {s1} WHERE {k1} IS NOT NULL) a "
        f"WHERE EXISTS (SELECT 1 FROM {s2} b WHERE CAST(b.{k2} AS VARCHAR) = a.k)"
        for t, s1, k1, s2, k2 in CLASH_KEYS
    ]
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def q_fan() -> str:
    lookups = [
        ("full_address", "", ["full_address"]),
        ("full_address_site1", "WHERE site_id = 1", ["full_address"]),
        ("full_address_site2", "WHERE site_id = 2", ["full_address"]),
        ("full_address_country", "", ["full_address", "country"]),
    ]
    parts = []
    for name, where, keys in lookups:
        not_null = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        where = f"{where} AND {not_null}" if where else f"WHERE {not_null}"
        parts.append(
            f"SELECT '{name}' AS lookup, {_key_text(keys)} AS key_text, "
            f"CAST(COUNT(*) AS BIGINT) AS matches, MIN(ODS_address_id) AS min_id, "
            f"MAX(ODS_address_id) AS max_id FROM l_address {where} "
            f"GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def q_drop() -> str:
    cases = [
        ("customer_2", "Stg_Customers", "l_address", "site_id = 2", "src.Address = r.full_address"),
        ("employee_territory", "Stg_EmployeeTerritories", "l_employee", "record_orig_site_id = 2",
         "src.EmployeeID = r.orig_employee_id"),
        ("product_1", "Stg_StockItem", "l_supplier", "site_id = 1", "src.SupplierId = r.orig_supplier_id"),
        ("product_2", "Stg_Products", "l_supplier", "site_id = 2", "src.SupplierID = r.orig_supplier_id"),
        ("order_1", "Stg_OrderHeader", "l_employee", "record_orig_site_id = 1",
         "src.SalesPersonId = r.orig_employee_id"),
        ("order_2", "Stg_Orders", "l_employee", "record_orig_site_id = 2",
         "src.EmployeeID = r.orig_employee_id"),
    ]
    parts = [
        f"SELECT '{arm}' AS arm, CAST(COUNT(*) AS BIGINT) AS source_rows, "
        f"CAST(SUM(CASE WHEN NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{cond} AND {match}) "
        f"THEN 1 ELSE 0 END) AS BIGINT) AS dropped FROM {src} src"
        for arm, src, ref, cond, match in cases
    ]
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


# Staging as a system without the targets' widths sends it.
RAW = {
    "raw_customer": """SELECT * REPLACE (
        CASE WHEN CustomerId % 10 = 1 THEN CustomerId + 100000 ELSE CustomerId END AS CustomerId,
        CASE WHEN CustomerId % 5 = 2 THEN ContactName || ' of ' || repeat(CustomerName, CustomerId % 4)
             ELSE ContactName END AS ContactName) FROM Stg_Customer""",
    "raw_item": """SELECT * REPLACE (
        CAST(Cost * COALESCE(QuantityPerOuter, 1) AS DECIMAL(12,2)) AS Cost,
        CAST(CASE WHEN StockItemId % 3 = 0 THEN RetailPrice * COALESCE(QuantityPerOuter, 1) ELSE RetailPrice END
             AS DECIMAL(12,2)) AS RetailPrice) FROM Stg_StockItem""",
}


def _misfits(tests: list[tuple[str, str]]) -> str:
    """Names of the tests that a row meets, in order; tests are listed in that order."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in tests) + ")"


def q_reject() -> str:
    states = {t: f"p_{t}" for t in ORDER}
    wide = lambda col, width, value: (f"width:{col}", f"length({value}) > {width}")
    price = lambda col, value: (f"range:{col}", f"abs({value}) > 999.99")
    customer_cols = [("company_name", 50), ("contact_job_title", 50), ("contact_name", 50), ("orig_customer_id", 5), ("phone", 20)]
    item_cols = [("bin_location", 50), ("category_name", 50), ("color", 50), ("name", 100), ("quantity_per_unit", 20), ("size", 50)]
    prices = [price(c, c) for c in ("unit_price", "wholesale_price")]
    parts = []
    for table, arms, widths, extra in (
            ("customer", ["customer_1", "customer_2"], customer_cols, []),
            ("product", ["product_1", "product_2"], item_cols, prices)):
        why = _misfits([*extra, *(wide(c, w, q(c)) for c, w in widths)])
        key = f"orig_{table}_id"
        for arm in arms:
            rule = INSERTS[table][arm]
            rule = replace(rule, src={"Stg_Customer": "raw_customer", "Stg_StockItem": "raw_item"}.get(rule.src, rule.src))
            parts.append(f"SELECT '{table}' AS table_name, 'n_{table}' AS statement, CAST({key} AS VARCHAR) AS key_text, "
                         f"{why} AS reasons FROM ({new_rows(table, rule, states)}) r")
    # updates: staged rows of a key that the ODS holds, judged by the columns that are set
    why = _misfits([wide("company_name", 50, "CustomerName"), wide("contact_name", 50, "ContactName"),
                    wide("phone", 20, "PhoneNumber")])
    parts.append(f"SELECT 'customer' AS table_name, 'u_customer_1' AS statement, CAST(CustomerId AS VARCHAR) AS key_text, "
                 f"{why} AS reasons FROM raw_customer WHERE EXISTS "
                 "(SELECT 1 FROM p_customer t WHERE t.orig_customer_id = CAST(CustomerId AS VARCHAR))")
    why = _misfits([price("unit_price", "Cost"), price("wholesale_price", "RetailPrice"), wide("color", 50, "Color"),
                    wide("name", 100, "StockItemName"), wide("size", 50, "Size")])
    # the update reads only items with a stock, a category and a known supplier
    parts.append(f"SELECT 'product' AS table_name, 'u_product_1' AS statement, CAST(StockItemId AS VARCHAR) AS key_text, "
                 f"{why} AS reasons FROM raw_item WHERE EXISTS (SELECT 1 FROM p_product t WHERE t.orig_product_id = raw_item.StockItemId) "
                 "AND EXISTS (SELECT 1 FROM Stg_StockItemInventory h WHERE h.StockItemID = raw_item.StockItemId) "
                 "AND EXISTS (SELECT 1 FROM Stg_ItemCategory g WHERE g.CategoryId = raw_item.ItemCategoryId) "
                 "AND EXISTS (SELECT 1 FROM p_supplier m WHERE m.site_id = 1 AND m.orig_supplier_id = raw_item.SupplierId)")
    rows = "\nUNION ALL\n".join(parts)
    return _with(base_ctes("site") + list(RAW.items()),
                 f"SELECT DISTINCT table_name, statement, key_text, reasons FROM ({rows}) every_row WHERE reasons <> ''")


def kept_clash() -> str:
    """Per table of both sites: source keys that rows of site 1 and of site 2 hold."""
    parts = []
    for name in ORDER:
        t = TABLES[name]
        if t.orig_col and t.site_col:
            both = (f"SELECT {q(t.orig_col)} FROM l_{name} WHERE {q(t.orig_col)} IS NOT NULL GROUP BY {q(t.orig_col)} "
                    f"HAVING bool_or({q(t.site_col)} = 1) AND bool_or({q(t.site_col)} = 2)")
            parts.append(f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS clashes FROM ({both}) k")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def kept_statements() -> dict[str, str]:
    """The reports on states, however they are made."""
    return {"kept_pk": f"SELECT * FROM ({q_pk()}) r WHERE table_name <> 'employee_territory_new'",
            "kept_fk": q_fk(), "kept_fan": q_fan(), "kept_clash": kept_clash()}


def check_statements() -> dict[str, str]:
    return {"q_pk": q_pk(), "q_fk": q_fk(), "q_len": q_len(), "q_range": q_range(),
            "q_clash": q_clash(), "q_fan": q_fan(), "q_drop": q_drop(),
            "q_reject": q_reject(), **kept_statements()}

