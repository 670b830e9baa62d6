"""Oracle SQL (DuckDB) for the loads, their arms and the whole-table results.

Layout of every statement: one ``WITH`` list holding the staging tables
(derived from the raw test tables), the prior state of the ODS tables
(a load at 2024-01-01 of the rows with ``n % 5 <> 0``, one tracked column
changed) and the step under test, then a final ``SELECT`` cast to the target
column types.
"""

from __future__ import annotations

from pyspark.sql import types as T

from sitemerge.sources.targets import TABLES

from .rules import CHANGES, INSERTS, Change, Insert, Map

LOAD_TS = "TIMESTAMP '2024-11-24 00:00:00'"
PRIOR_TS = "TIMESTAMP '2024-01-01 00:00:00'"
DATE_SENTINEL = "TIMESTAMP '1900-01-01 00:00:00'"


def duck_type(dt: T.DataType) -> str:
    if isinstance(dt, T.ShortType):
        return "SMALLINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    raise TypeError(dt)


def q(name: str) -> str:
    return f'"{name}"'


def cast_list(table: str, alias: str = "", cols: list[str] | None = None) -> str:
    t = TABLES[table]
    pre = f"{alias}." if alias else ""
    return ", ".join(
        f"CAST({pre}{q(c)} AS {duck_type(t.col(c).stored)}) AS {q(c)}" for c in (cols or t.names)
    )


# --------------------------------------------------------------------------- staging

STAGING = {
    "Stg_Region": """SELECT CAST(r_regionkey AS BIGINT) AS RegionID,
        CAST(r_name AS VARCHAR) AS RegionDescription FROM region""",
    "Stg_Address": """SELECT CAST(c_custkey AS BIGINT) AS AddressId,
        concat(c_custkey, ' Main Street') AS AddressLine1,
        CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE concat('Unit ', c_custkey % 9) END AS AddressLine2,
        concat('City ', c_custkey % 50) AS City,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('S', c_custkey % 20) END AS State,
        lpad(CAST(c_custkey AS VARCHAR), greatest(5, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS ZipCode,
        CAST(1 AS SMALLINT) AS RecordOrigSiteId
        FROM customer WHERE c_custkey % 2 = 1""",
    "Stg_Customer": """SELECT CAST(c_custkey AS BIGINT) AS CustomerId,
        c_name AS CustomerName,
        CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('Contact ', c_custkey) END AS ContactName,
        concat('555-', c_custkey) AS PhoneNumber,
        CAST(c_custkey AS BIGINT) AS BillingAddressId,
        CAST(CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_custkey
                  ELSE c_custkey + 2 END AS BIGINT) AS DeliveryAddressId,
        CAST(1 AS SMALLINT) AS RecordOrigSiteId
        FROM customer WHERE c_custkey % 2 = 1""",
    "Stg_Customers": """SELECT CAST(c_custkey AS VARCHAR) AS CustomerID,
        c_name AS CompanyName,
        CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('Contact ', c_custkey) END AS ContactName,
        c_mktsegment AS ContactTitle,
        concat('556-', c_custkey) AS Phone,
        CASE WHEN c_custkey % 22 = 0 THEN NULL
             ELSE concat('Avenue ', CASE WHEN c_custkey % 20 = 18 THEN c_custkey - 2 ELSE c_custkey END)
        END AS Address,
        concat('City ', c_nationkey) AS City,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('R', c_nationkey) END AS Region,
        lpad(CAST(c_nationkey AS VARCHAR), greatest(5, length(CAST(c_nationkey AS VARCHAR)))::INTEGER, '0') AS PostalCode,
        concat('NATION_', c_nationkey) AS Country,
        CAST(2 AS SMALLINT) AS SiteId
        FROM customer WHERE c_custkey % 2 = 0""",
    "Stg_SalesPerson": """SELECT CAST(user_id AS BIGINT) AS SalesPersonId,
        concat('First', user_id) AS FirstName,
        concat('Last', user_id) AS LastName,
        concat('557-', user_id) AS PhoneNumber,
        CASE WHEN user_id % 11 = 0 THEN NULL ELSE concat('u', user_id, '@site1.test') END AS Email,
        CAST(CASE WHEN user_id % 7 = 0 THEN 0 ELSE 1 END AS SMALLINT) AS IsActive,
        CAST(1 AS SMALLINT) AS RecordOrigSiteId
        FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 2 = 1""",
    "Stg_Employees": """SELECT CAST(user_id AS BIGINT) AS EmployeeID,
        concat('First', user_id) AS FirstName,
        concat('Last', user_id) AS LastName,
        concat('Job ', user_id % 6) AS JobTitle,
        CASE WHEN user_id % 9 = 0 THEN NULL ELSE TIMESTAMP '1980-02-03 00:00:00' END AS BirthDate,
        TIMESTAMP '2010-05-06 00:00:00' AS HireDate,
        CASE WHEN user_id % 8 = 0 THEN TIMESTAMP '2020-07-08 00:00:00' ELSE NULL END AS TerminationDate,
        concat('558-', user_id) AS HomePhone,
        CASE WHEN user_id % 6 = 0 THEN NULL
             ELSE concat('Lane ', CASE WHEN user_id % 20 = 18 THEN user_id - 2 ELSE user_id END)
        END AS Address,
        concat('City ', user_id % 3) AS City,
        concat('R', user_id % 5) AS StateOrRegion,
        lpad(CAST(user_id AS VARCHAR), greatest(5, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS PostalCode,
        concat('NATION_', user_id % 25) AS Country,
        concat('u', user_id, '@site2.test') AS EmailAddress,
        CAST(CASE WHEN user_id = 0 THEN NULL ELSE user_id % 4 END AS BIGINT) AS ReportsTo,
        concat('note ', user_id) AS Notes,
        CAST(2 AS SMALLINT) AS SiteId
        FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 2 = 0""",
    "Stg_Supplier": """SELECT CAST(s_suppkey AS BIGINT) AS SupplierId,
        s_name AS SupplierName,
        concat('Contact ', s_suppkey) AS ContactName,
        concat('559-', s_suppkey) AS PhoneNumber,
        CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat('www', s_suppkey, '.test') END AS Website,
        CAST(s_suppkey AS BIGINT) AS AddressId,
        CAST(1 AS SMALLINT) AS SiteId
        FROM supplier WHERE s_suppkey % 2 = 1""",
    "Stg_Suppliers": """SELECT CAST(s_suppkey AS BIGINT) AS SupplierID,
        s_name AS CompanyName,
        concat('Contact ', s_suppkey) AS ContactName,
        concat('Title ', s_suppkey % 4) AS ContactTitle,
        concat('560-', s_suppkey) AS Phone,
        concat('Road ', s_suppkey) AS Address,
        concat('City ', s_nationkey) AS City,
        concat('R', s_nationkey) AS StateOrRegion,
        lpad(CAST(s_nationkey AS VARCHAR), greatest(5, length(CAST(s_nationkey AS VARCHAR)))::INTEGER, '0') AS PostalCode,
        concat('NATION_', s_nationkey) AS Country,
        CAST(2 AS SMALLINT) AS SiteId
        FROM supplier WHERE s_suppkey % 2 = 0""",
    "Stg_Territories": """SELECT lpad(CAST(n_nationkey AS VARCHAR), greatest(5, length(CAST(n_nationkey AS VARCHAR)))::INTEGER, '0') AS TerritoryID,
        n_name AS TerritoryDescription,
        CAST(n_regionkey AS BIGINT) AS RegionID,
        CAST(2 AS SMALLINT) AS SiteId
        FROM nation""",
    "Stg_EmployeeTerritories": """SELECT CAST(user_id AS BIGINT) AS EmployeeID,
        CASE WHEN user_id % 10 = 4 THEN '99999'
             ELSE lpad(CAST(user_id % 25 AS VARCHAR), greatest(5, length(CAST(user_id % 25 AS VARCHAR)))::INTEGER, '0') END AS TerritoryID
        FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 2 = 0""",
    "Stg_StockItem": """SELECT CAST(p_partkey AS BIGINT) AS StockItemId,
        p_name AS StockItemName,
        CAST(p_size % 6 AS BIGINT) AS ItemCategoryId,
        CAST(2 * (p_partkey % 5) + 1 AS BIGINT) AS SupplierId,
        p_brand AS Color,
        p_type AS Size,
        CAST(CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS INTEGER) AS QuantityPerOuter,
        CAST(p_retailprice AS DECIMAL(5,2)) AS Cost,
        CAST(p_retailprice AS DECIMAL(5,2)) AS RetailPrice,
        CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END AS SMALLINT) AS IsActive,
        CAST(1 AS SMALLINT) AS SiteId
        FROM part WHERE p_partkey % 2 = 1""",
    "Stg_StockItemInventory": """SELECT CAST(p_partkey AS BIGINT) AS StockItemID,
        CAST(p_size * 3 AS INTEGER) AS QuantityOnHand,
        CAST(p_size AS INTEGER) AS ReorderLevel,
        CAST(p_size * 5 AS INTEGER) AS TargetStockLevel,
        concat('B', p_size) AS BinLocation,
        TIMESTAMP '2024-01-02 03:04:05' AS LastEditDateTime
        FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 5 <> 0""",
    "Stg_ItemCategory": """SELECT CAST(r_regionkey AS BIGINT) AS CategoryId,
        r_name AS Category FROM region""",
    "Stg_Products": """SELECT CAST(p_partkey AS BIGINT) AS ProductID,
        p_name AS ProductName,
        CAST(p_size % 6 AS BIGINT) AS CategoryID,
        CAST(2 * (p_partkey % 5) AS BIGINT) AS SupplierID,
        concat(p_size, ' per box') AS QuantityPerUnit,
        CAST(p_retailprice AS DECIMAL(5,2)) AS UnitPrice,
        CAST(CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_retailprice END AS DECIMAL(5,2)) AS WholesalePrice,
        CAST(p_size AS INTEGER) AS UnitsInStock,
        CAST(p_size % 4 AS INTEGER) AS UnitsOnOrder,
        CAST(p_size % 7 AS INTEGER) AS ReorderLevel,
        p_partkey % 12 = 0 AS Discontinued,
        CAST(2 AS SMALLINT) AS SiteId
        FROM part WHERE p_partkey % 2 = 0""",
    "Stg_Categories": """SELECT CAST(r_regionkey AS BIGINT) AS CategoryID,
        r_name AS CategoryName, concat('All of ', r_name) AS Description FROM region""",
    "Stg_OrderHeader": """SELECT CAST(o_orderkey AS BIGINT) AS OrderId,
        CAST(o_custkey AS BIGINT) AS CustomerId,
        CAST(2 * (o_custkey % 7) + 1 AS BIGINT) AS SalesPersonId,
        CAST(o_orderdate AS TIMESTAMP) AS OrderDate,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL
             ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 DAY END AS ShipDate,
        concat('PO', o_orderkey) AS CustomerPurchaseOrderNumber,
        CAST(1 AS SMALLINT) AS SiteId
        FROM orders WHERE o_orderkey % 2 = 1""",
    "Stg_Orders": """SELECT CAST(o_orderkey AS BIGINT) AS OrderID,
        CAST(o_custkey AS VARCHAR) AS CustomerID,
        CAST(2 * (o_custkey % 7) AS BIGINT) AS EmployeeID,
        CAST(o_orderdate AS TIMESTAMP) AS OrderDate,
        CAST(o_orderdate AS TIMESTAMP) + INTERVAL 14 DAY AS RequiredDate,
        CAST(o_orderkey % 4 AS BIGINT) AS ShipVia,
        CAST(CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE o_totalprice END AS DECIMAL(19,4)) AS Freight,
        CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE concat('Dock ', o_custkey % 97) END AS ShipAddress,
        concat('City ', o_custkey % 2) AS ShipCity,
        concat('R', o_custkey % 2) AS ShipStateOrRegion,
        lpad(CAST(o_custkey % 97 AS VARCHAR), greatest(5, length(CAST(o_custkey % 97 AS VARCHAR)))::INTEGER, '0') AS ShipPostalCode,
        concat('NATION_', o_custkey % 25) AS ShipCountry,
        CAST(2 AS SMALLINT) AS SiteId
        FROM orders WHERE o_orderkey % 2 = 0""",
    "Stg_Shippers": """SELECT CAST(r_regionkey AS BIGINT) AS ShipperID,
        concat('Ship ', r_name) AS CompanyName,
        concat('561-', r_regionkey) AS Phone
        FROM region WHERE r_regionkey < 3""",
    "Stg_OrderLine": """SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS OrderLineId,
        CAST(l_orderkey AS BIGINT) AS OrderId,
        CAST(l_partkey AS BIGINT) AS StockItemId,
        CAST(l_quantity AS INTEGER) AS Quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
        CAST(l_tax AS DECIMAL(5,2)) AS TaxRate,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END AS ItemPickedDate,
        CAST(1 AS SMALLINT) AS SiteId
        FROM lineitem WHERE l_orderkey % 2 = 1""",
    "Stg_OrderDetails": """SELECT CAST(l_orderkey AS BIGINT) AS OrderID,
        CAST(l_partkey AS BIGINT) AS ProductID,
        CAST(l_quantity AS INTEGER) AS Quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
        CAST(l_discount AS DECIMAL(5,2)) AS Discount,
        CAST(2 AS SMALLINT) AS SiteId
        FROM lineitem WHERE l_orderkey % 2 = 0""",
}


# --------------------------------------------------------------------------- arms
#
# Each arm is the INSERT ... SELECT DISTINCT of one source, with two extras
# for building the prior state: ``prior=True`` drops the anti-join, keeps the
# rows with n % 5 <> 0 and changes one tracked column.  ``S`` maps a table
# name to the CTE holding its current state.


# --------------------------------------------------------------------------- rules to statements

# What a missing value compares as, by kind.
DEFAULTS = {"text": "''", "date": DATE_SENTINEL, "price": "-1", "count": "0", "flag": "FALSE"}

# The two source systems as the site load declares them.
SITES = "(VALUES (1, 'SouthwindSales'), (2, 'NW_Traders_Sales')) AS s(site_id, name)"


def joined(maps: dict[str, Map], states: dict[str, str]) -> str:
    """The key maps as named sub-selects joined to the staging row."""
    out = []
    for name, m in maps.items():
        on = f"{name}.k = {m.key}" + (f" AND {name}.k2 = {m.key2}" if m.key2 else "")
        out.append(f"{'JOIN' if m.needed else 'LEFT JOIN'} ({m.select.format(**states)}) {name} ON {on}")
    return "\n".join(out)


def bent(rule: Insert, value: str) -> str:
    """The other value that the prior state holds of a row."""
    if rule.bent == "quantity_per_unit":
        return f"{value} + CAST(({rule.n}) % 7 = 0 AS INTEGER)"
    return f"CASE WHEN ({rule.n}) % 11 = 0 THEN NULL ELSE {value} || CASE WHEN ({rule.n}) % 7 = 0 THEN ' old' ELSE '' END END"


def new_rows(table: str, rule: Insert, states: dict[str, str], prior: bool = False) -> str:
    """The rows an arm inserts; with ``prior`` those the prior state was made of."""
    stamp = PRIOR_TS if prior else LOAD_TS
    cols = []
    for c in TABLES[table].insert_cols:
        value = rule.cols.get(c, f"CAST(NULL AS {duck_type(TABLES[table].col(c).stored)})").replace("{now}", stamp)
        if c == "date_created":
            value = stamp
        elif c == "last_update":
            value = f"CAST({rule.stamp if rule.stamp and not prior else 'NULL'} AS TIMESTAMP)"
        elif prior and c == rule.bent:
            value = bent(rule, value)
        cols.append(f"{value} AS {q(c)}")
    same = " AND ".join(f"t.{q(c)} = {rule.cols[c]}" for c in rule.absent)
    keep = f"({rule.n}) % 5 <> 0" if prior else f"NOT EXISTS (SELECT 1 FROM {states[table]} t WHERE {same})"
    return (f"SELECT DISTINCT {', '.join(cols)}\nFROM {rule.src} s\n{joined(rule.maps, states)}\n"
            f"WHERE {keep}" + (f" AND {rule.only}" if rule.only else ""))


def new_sites(states: dict[str, str], prior: bool = False) -> str:
    keep = "site_id = 1" if prior else f"site_id NOT IN (SELECT site_id FROM {states['site']})"
    return (f"SELECT CAST(site_id AS SMALLINT) AS site_id, name, {PRIOR_TS if prior else LOAD_TS} AS date_created, "
            f"CAST(NULL AS TIMESTAMP) AS last_update FROM {SITES} WHERE {keep}")


def all_new(table: str, states: dict[str, str], prior: bool = False) -> str:
    if table == "site":
        return new_sites(states, prior)
    return "\nUNION\n".join(f"({new_rows(table, rule, states, prior)})" for rule in INSERTS[table].values())


def changed(table: str, rule: Change, states: dict[str, str], state: str) -> str:
    """The table after one update: of the staging rows that differ from a target row
    the one with the smallest new values, NULLs first."""
    t, key = TABLES[table], q(TABLES[table].id_col)
    names, values, differ = [], [], []
    for name, *rest in rule.sets:
        if len(rest) == 2:
            kind, value = rest
            mine, its = (f"COALESCE({x}, {DEFAULTS[kind]})" for x in (value, f"t.{q(name)}"))
        else:
            value, mine, its = rest
        names.append(name)
        values.append(f"{value} AS new_{name}")
        differ.append(f"{mine} <> {its}")
    by = " AND ".join(f"t.{q(c)} = {value}" for c, value in rule.by.items())
    order = ", ".join(f"new_{n} NULLS FIRST" for n in names)
    picks = (f"SELECT DISTINCT ON (t.{key}) t.{key} AS pick, {', '.join(values)}\nFROM {rule.src} s\n"
             f"{joined(rule.maps, states)}\nJOIN {state} t ON {by}\nWHERE {' OR '.join(differ)}\n"
             f"ORDER BY t.{key}, {order}")
    cols = []
    for c in t.cols:
        old, typ = f"t.{q(c.name)}", duck_type(c.stored)
        new = f"CAST(p.new_{c.name} AS {typ})" if c.name in names else LOAD_TS if c.name == "last_update" else None
        cols.append(f"CASE WHEN p.pick IS NULL THEN {old} ELSE {new} END AS {q(c.name)}" if new else old)
    return f"SELECT {', '.join(cols)} FROM {state} t LEFT JOIN ({picks}) p ON p.pick = t.{key}"


def with_ids(table: str, rows_cte: str, start_sql: str = "0") -> str:
    """``SELECT`` of the rows with ids after ``start_sql``, cast to the table."""
    t = TABLES[table]
    if not t.id_col:
        return f"SELECT {cast_list(table)} FROM {rows_cte}"
    order = ", ".join(f"{q(c)} NULLS FIRST" for c in t.order_cols)
    inner = (f"SELECT ({start_sql}) + row_number() OVER (ORDER BY {order}) AS {q(t.id_col)}, * "
             f"FROM {rows_cte}")
    return f"SELECT {cast_list(table)} FROM ({inner}) numbered"


# --------------------------------------------------------------------------- prior state

ORDER = list(TABLES)


def prior_ctes() -> list[tuple[str, str]]:
    S = {name: f"p_{name}" for name in ORDER}
    ctes = []
    for name in ORDER:
        ctes.append((f"pr_{name}", all_new(name, S, prior=True)))
        ctes.append((f"p_{name}", with_ids(name, f"pr_{name}")))
    return ctes


# --------------------------------------------------------------------------- statements
#
# The loads run in foreign-key order: a table's load reads its own prior
# state and its parents' states after their loads (``l_<table>``).


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def state_map(name: str) -> dict[str, str]:
    i = ORDER.index(name)
    return {t: (f"l_{t}" if j < i else f"p_{t}") for j, t in enumerate(ORDER)}


def update_ctes(name: str, upto: int | None = None) -> tuple[list[tuple[str, str]], str]:
    """CTEs of the table's updates in order; returns them and the last name."""
    ctes, state = [], f"p_{name}"
    for i, rule in enumerate(CHANGES.get(name, [])[:upto], start=1):
        cte = f"u_{name}_{i}"
        ctes.append((cte, changed(name, rule, state_map(name), state)))
        state = cte
    return ctes, state


def _arm_states(name: str, updated: str) -> dict[str, str]:
    S = state_map(name)
    S[name] = updated
    return S


def load_ctes(name: str) -> list[tuple[str, str]]:
    """Updates, new rows and the resulting state ``l_<name>`` of one load."""
    ctes, state = update_ctes(name)
    t = TABLES[name]
    start = f"SELECT COALESCE(MAX({q(t.id_col)}), 0) FROM {state}" if t.id_col else "0"
    ctes += [(f"new_{name}", all_new(name, _arm_states(name, state))),
             (f"l_{name}", f"SELECT {cast_list(name)} FROM {state} UNION ALL "
                           f"{with_ids(name, f'new_{name}', start)}")]
    return ctes


def base_ctes(name: str | None = None) -> list[tuple[str, str]]:
    """Staging, prior state and the loads of every table before ``name``."""
    ctes = list(STAGING.items()) + prior_ctes()
    for t in ORDER[: ORDER.index(name) if name else len(ORDER)]:
        ctes += load_ctes(t)
    return ctes


def u_statement(name: str, upto: int) -> str:
    ctes, state = update_ctes(name, upto)
    return _with(base_ctes(name) + ctes, f"SELECT {cast_list(name)} FROM {state}")


def n_statement(name: str, arm: str) -> str:
    ctes, state = update_ctes(name)
    t = TABLES[name]
    rows = new_rows(name, INSERTS[name][arm], _arm_states(name, state))
    return _with(base_ctes(name) + ctes + [("arm", rows)],
                 f"SELECT {cast_list(name, cols=t.insert_cols)} FROM arm")


def load_statement(name: str) -> str:
    return _with(base_ctes(name) + load_ctes(name), f"SELECT * FROM l_{name}")


def pipeline_counts_statement() -> str:
    parts = []
    for t in ORDER:
        upd = ("SUM(CASE WHEN last_update = " + LOAD_TS + " THEN 1 ELSE 0 END)"
               if "last_update" in TABLES[t].names else "0")
        parts.append(
            f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, "
            f"CAST(COALESCE(SUM(CASE WHEN date_created = {LOAD_TS} THEN 1 ELSE 0 END), 0) AS BIGINT) "
            f"AS inserted, CAST(COALESCE({upd}, 0) AS BIGINT) AS updated FROM l_{t}")
    return _with(base_ctes(), "\nUNION ALL\n".join(parts))


def oracle_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in ORDER:
        n_up = len(CHANGES.get(name, []))
        for i in range(1, n_up + 1):
            key = f"u_{name}" if n_up == 1 else f"u_{name}_{i}"
            out[key] = u_statement(name, i)
        if name != "site":
            for arm in INSERTS[name]:
                out[f"n_{arm}"] = n_statement(name, arm)
            out[f"load_{name}"] = load_statement(name)
    out["pipeline_counts"] = pipeline_counts_statement()
    return out
