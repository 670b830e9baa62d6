"""Oracle SQL for the single-operator queries, over staging and prior state."""

from __future__ import annotations

from .sql import DATE_SENTINEL, LOAD_TS, _with, base_ctes, update_ctes


def _w(final: str) -> str:
    return _with(base_ctes("site"), final)


def operator_statements() -> dict[str, str]:
    lineitem_cols = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                     "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in lineitem_cols.split(","))
    ctes, state = update_ctes("address")
    return {
        "null_default_eq": _w(f"""SELECT t.ODS_employee_id AS ODS_employee_id,
            COALESCE(s.FirstName, '') = COALESCE(t.first_name, '') AS eq_first_name,
            COALESCE(s.BirthDate, {DATE_SENTINEL}) = COALESCE(t.birth_date, {DATE_SENTINEL}) AS eq_birth_date,
            COALESCE(s.TerminationDate, {DATE_SENTINEL}) = COALESCE(t.termination_date, {DATE_SENTINEL})
                AS eq_termination_date,
            COALESCE(CAST(s.ReportsTo AS VARCHAR), '') = COALESCE(t.reports_to, '') AS eq_reports_to,
            COALESCE(s.EmailAddress, '') = COALESCE(t.email, '') AS eq_email
            FROM Stg_Employees s JOIN p_employee t ON s.EmployeeID = t.orig_employee_id"""),
        "changed_rows": _with(base_ctes("address") + ctes, f"""SELECT ODS_address_id, full_address,
            city, state, postal_code FROM {state} WHERE last_update = {LOAD_TS}"""),
        "concat_null_empty": _w("""SELECT AddressId,
            CONCAT(AddressLine1, ' ', AddressLine2) AS full_address FROM Stg_Address"""),
        "flag_case": _w("""SELECT StockItemId, IsActive,
            CASE WHEN IsActive = 1 THEN FALSE ELSE TRUE END AS discontinued FROM Stg_StockItem"""),
        "term_case": _w(f"""SELECT SalesPersonId, IsActive,
            CASE WHEN IsActive = 0 THEN {LOAD_TS} ELSE NULL END AS termination_date
            FROM Stg_SalesPerson"""),
        "cast_narrow": _w("""SELECT OrderLineId AS line_id,
            CAST(UnitPrice AS DECIMAL(18,0)) AS unit_price, CAST(TaxRate AS DECIMAL(18,0)) AS tax_rate,
            CAST(Quantity AS VARCHAR) AS quantity_text FROM Stg_OrderLine"""),
        "typed_nulls": _w("""SELECT StockItemId AS orig_product_id, Color AS color,
            CAST(NULL AS INTEGER) AS units_on_order, CAST(1 AS SMALLINT) AS site_id FROM Stg_StockItem
            UNION ALL
            SELECT ProductID, CAST(NULL AS VARCHAR), UnitsOnOrder, CAST(2 AS SMALLINT) FROM Stg_Products"""),
        "union_distinct": _w("""
            SELECT Address AS full_address, City AS city, Region AS state, PostalCode AS postal_code,
                Country AS country, SiteId AS site_id FROM Stg_Customers
            UNION SELECT Address, City, StateOrRegion, PostalCode, Country, SiteId FROM Stg_Employees
            UNION SELECT Address, City, StateOrRegion, PostalCode, Country, SiteId FROM Stg_Suppliers
            UNION SELECT ShipAddress, ShipCity, ShipStateOrRegion, ShipPostalCode, ShipCountry, SiteId
                FROM Stg_Orders"""),
        "gate_semi": _w("""SELECT ol.OrderLineId, ol.OrderId, ol.StockItemId, ol.Quantity
            FROM Stg_OrderLine ol
            WHERE EXISTS (SELECT 1 FROM p_order o WHERE o.orig_order_id = ol.OrderId
                          AND o.site_id = ol.SiteId)
              AND EXISTS (SELECT 1 FROM p_product p WHERE p.orig_product_id = ol.StockItemId
                          AND p.site_id = ol.SiteId)"""),
        "lookup_left": _w("""SELECT t.TerritoryID, r.ODS_region_id FROM Stg_Territories t
            LEFT JOIN p_region r ON t.RegionID = r.orig_region_id"""),
        "lookup_chain": _w("""SELECT oh.OrderId, a.ODS_address_id FROM Stg_OrderHeader oh
            LEFT JOIN Stg_Customer oc ON oh.CustomerId = oc.CustomerId
            LEFT JOIN Stg_Address oa ON oc.DeliveryAddressId = oa.AddressId
            LEFT JOIN p_address a ON oa.AddressId = a.orig_address_id"""),
        "lookup_twice": _w("""SELECT c.CustomerId, a1.ODS_address_id AS ODS_address_id,
            a2.ODS_address_id AS ODS_delivery_address_id
            FROM Stg_Customer c
            LEFT JOIN Stg_Address b ON c.BillingAddressId = b.AddressId
            LEFT JOIN Stg_Address d ON c.DeliveryAddressId = d.AddressId
            LEFT JOIN p_address a1 ON CONCAT(b.AddressLine1, ' ', b.AddressLine2) = a1.full_address
                AND a1.site_id = 1
            LEFT JOIN p_address a2 ON CONCAT(d.AddressLine1, ' ', d.AddressLine2) = a2.full_address
                AND a2.site_id = 1"""),
        "assign_ids": f"""SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS line_id
            FROM (SELECT DISTINCT {lineitem_cols} FROM lineitem) l""",
    }
