"""The eleven ODS target tables: columns, widths, keys and references.

Types follow the target DDL mapped to Spark: tinyint and smallint become
``short`` (tinyint is unsigned 0-255, Spark's byte is signed), ``datetime``
becomes ``timestamp_ntz``, ``money`` ``decimal(19,4)`` and a bare ``decimal``
``decimal(18,0)``.  Source and surrogate keys are stored as ``long`` whatever the
DDL's width, so that no load fails by size.  Text widths are kept as column metadata (``width``); Spark
neither cuts nor rejects over-long strings, so ``operators.quality.check_length``
enforces them.

The address table uses one ``full_address`` column as every load does; its
width (101: two 50-character lines and the joining blank) is our choice.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

SHORT = T.ShortType()
LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
TS = T.TimestampNTZType()
BOOL = T.BooleanType()


def DEC(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    width: int | None = None

    @property
    def stored(self) -> T.DataType:
        """``dtype`` is the DDL's type; source and surrogate keys are stored as ``long``."""
        whole = isinstance(self.dtype, (T.ShortType, T.IntegerType))
        return LONG if whole and re.fullmatch(r"(ODS|orig)_\w+_id", self.name) else self.dtype

    def field(self) -> T.StructField:
        meta = {"width": self.width} if self.width else {}
        return T.StructField(self.name, self.stored, True, meta)


@dataclass(frozen=True)
class ForeignKey:
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    cols: tuple[Col, ...]
    pk: tuple[str, ...]
    id_col: str | None = None  # identity(1,1) surrogate key
    orig_col: str | None = None  # source system key kept beside the surrogate
    site_col: str | None = None  # source system tag
    fks: tuple[ForeignKey, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.cols])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.cols]

    def col(self, name: str) -> Col:
        for c in self.cols:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    @property
    def insert_cols(self) -> list[str]:
        """Columns an insert provides: everything but the identity."""
        return [c for c in self.names if c != self.id_col]

    @property
    def order_cols(self) -> list[str]:
        """Total order for new ids: site, source key, the other business
        columns in table order, then the audit columns (a product's
        ``last_update`` is source data and may be all that tells two rows apart)."""
        audit = [c for c in ("date_created", "last_update") if c in self.names]
        head = [c for c in (self.site_col, self.orig_col) if c]
        rest = [c for c in self.insert_cols if c not in audit and c not in head]
        return head + rest + audit


def _t(name, cols, pk, **kw) -> Table:
    return Table(name, tuple(Col(*c) for c in cols), tuple(pk), **kw)


def _fk(cols, parent, parent_cols) -> ForeignKey:
    return ForeignKey(tuple(cols), parent, tuple(parent_cols))


SITE = _t(
    "site",
    [("site_id", SHORT), ("name", STR, 50), ("date_created", TS), ("last_update", TS)],
    ["site_id"],
)

REGION = _t(
    "region",
    [
        ("ODS_region_id", SHORT),
        ("orig_region_id", SHORT),
        ("description", STR, 100),
        ("date_created", TS),
        ("last_update", TS),
    ],
    ["ODS_region_id"],
    id_col="ODS_region_id",
    orig_col="orig_region_id",
)

ADDRESS = _t(
    "address",
    [
        ("ODS_address_id", INT),
        ("orig_address_id", INT),
        ("full_address", STR, 101),
        ("city", STR, 50),
        ("state", STR, 50),
        ("postal_code", STR, 10),
        ("country", STR, 50),
        ("date_created", TS),
        ("last_update", TS),
        ("site_id", SHORT),
    ],
    ["ODS_address_id"],
    id_col="ODS_address_id",
    orig_col="orig_address_id",
    site_col="site_id",
    fks=(_fk(["site_id"], "site", ["site_id"]),),
)

CUSTOMER = _t(
    "customer",
    [
        ("ODS_customer_id", INT),
        ("orig_customer_id", STR, 5),
        ("company_name", STR, 50),
        ("contact_name", STR, 50),
        ("contact_job_title", STR, 50),
        ("phone", STR, 20),
        ("ODS_address_id", INT),
        ("ODS_delivery_address_id", INT),
        ("date_created", TS),
        ("last_update", TS),
        ("record_orig_site_id", SHORT),
    ],
    ["ODS_customer_id"],
    id_col="ODS_customer_id",
    orig_col="orig_customer_id",
    site_col="record_orig_site_id",
    fks=(
        _fk(["ODS_address_id"], "address", ["ODS_address_id"]),
        _fk(["ODS_delivery_address_id"], "address", ["ODS_address_id"]),
        _fk(["record_orig_site_id"], "site", ["site_id"]),
    ),
)

EMPLOYEE = _t(
    "employee",
    [
        ("ODS_employee_id", SHORT),
        ("orig_employee_id", SHORT),
        ("first_name", STR, 50),
        ("last_name", STR, 50),
        ("job_title", STR, 50),
        ("birth_date", TS),
        ("hire_date", TS),
        ("termination_date", TS),
        ("phone", STR, 20),
        ("ODS_address_id", INT),
        ("email", STR, 50),
        ("reports_to", STR, 50),
        ("notes", STR, 200),
        ("date_created", TS),
        ("last_update", TS),
        ("record_orig_site_id", SHORT),
    ],
    ["ODS_employee_id"],
    id_col="ODS_employee_id",
    orig_col="orig_employee_id",
    site_col="record_orig_site_id",
    fks=(
        _fk(["ODS_address_id"], "address", ["ODS_address_id"]),
        _fk(["record_orig_site_id"], "site", ["site_id"]),
    ),
)

SUPPLIER = _t(
    "supplier",
    [
        ("ODS_supplier_id", INT),
        ("orig_supplier_id", INT),
        ("company_name", STR, 50),
        ("contact_name", STR, 50),
        ("contact_job_title", STR, 50),
        ("phone", STR, 20),
        ("website", STR, 100),
        ("ODS_address_id", INT),
        ("date_created", TS),
        ("last_update", TS),
        ("site_id", SHORT),
    ],
    ["ODS_supplier_id"],
    id_col="ODS_supplier_id",
    orig_col="orig_supplier_id",
    site_col="site_id",
    fks=(
        _fk(["ODS_address_id"], "address", ["ODS_address_id"]),
        _fk(["site_id"], "site", ["site_id"]),
    ),
)

TERRITORY = _t(
    "territory",
    [
        ("ODS_territory_id", SHORT),
        ("orig_territory_id", STR, 5),
        ("description", STR, 100),
        ("ODS_region_id", SHORT),
        ("date_created", TS),
        ("last_update", TS),
        ("record_orig_site_id", SHORT),
    ],
    ["ODS_territory_id"],
    id_col="ODS_territory_id",
    orig_col="orig_territory_id",
    site_col="record_orig_site_id",
    fks=(
        _fk(["record_orig_site_id"], "site", ["site_id"]),
        _fk(["ODS_region_id"], "region", ["ODS_region_id"]),
    ),
)

EMPLOYEE_TERRITORY = _t(
    "employee_territory",
    [("ODS_employee_id", SHORT), ("ODS_territory_id", SHORT), ("date_created", TS)],
    ["ODS_employee_id", "ODS_territory_id"],
    fks=(
        _fk(["ODS_employee_id"], "employee", ["ODS_employee_id"]),
        _fk(["ODS_territory_id"], "territory", ["ODS_territory_id"]),
    ),
)

PRODUCT = _t(
    "product",
    [
        ("ODS_product_id", INT),
        ("orig_product_id", INT),
        ("name", STR, 100),
        ("category_name", STR, 50),
        ("category_description", STR),
        ("ODS_supplier_id", INT),
        ("color", STR, 50),
        ("size", STR, 50),
        ("quantity_per_unit", STR, 20),
        ("unit_price", DEC(5, 2)),
        ("wholesale_price", DEC(5, 2)),
        ("units_in_stock", INT),
        ("units_on_order", INT),
        ("reorder_level", INT),
        ("target_stock_level", INT),
        ("bin_location", STR, 50),
        ("discontinued", BOOL),
        ("date_created", TS),
        ("last_update", TS),
        ("site_id", SHORT),
    ],
    ["ODS_product_id"],
    id_col="ODS_product_id",
    orig_col="orig_product_id",
    site_col="site_id",
    fks=(
        _fk(["ODS_supplier_id"], "supplier", ["ODS_supplier_id"]),
        _fk(["site_id"], "site", ["site_id"]),
    ),
)

ORDER = _t(
    "order",
    [
        ("ODS_order_id", INT),
        ("orig_order_id", INT),
        ("ODS_customer_id", INT),
        ("ODS_employee_id", SHORT),
        ("ODS_address_id", INT),
        ("order_date", TS),
        ("ship_date", TS),
        ("required_date", TS),
        ("order_number", STR, 50),
        ("ship_via", STR, 50),
        ("shipping_company_phone", STR, 20),
        ("freight", DEC(19, 4)),
        ("date_created", TS),
        ("last_update", TS),
        ("site_id", SHORT),
    ],
    ["ODS_order_id"],
    id_col="ODS_order_id",
    orig_col="orig_order_id",
    site_col="site_id",
    fks=(
        _fk(["ODS_customer_id"], "customer", ["ODS_customer_id"]),
        _fk(["ODS_employee_id"], "employee", ["ODS_employee_id"]),
        _fk(["ODS_address_id"], "address", ["ODS_address_id"]),
        _fk(["site_id"], "site", ["site_id"]),
    ),
)

ORDER_DETAIL = _t(
    "order_detail",
    [
        ("ODS_order_detail_id", INT),
        ("orig_order_detail_id", INT),
        ("ODS_order_id", INT),
        ("ODS_product_id", INT),
        ("quantity_per_unit", INT),
        ("unit_price", DEC(18, 0)),
        ("tax_rate", DEC(18, 0)),
        ("item_picked_date", TS),
        ("discount", DEC(18, 0)),
        ("date_created", TS),
        ("last_update", TS),
        ("site_id", SHORT),
    ],
    ["ODS_order_detail_id"],
    id_col="ODS_order_detail_id",
    orig_col="orig_order_detail_id",
    site_col="site_id",
    fks=(
        _fk(["ODS_order_id"], "order", ["ODS_order_id"]),
        _fk(["ODS_product_id"], "product", ["ODS_product_id"]),
        _fk(["site_id"], "site", ["site_id"]),
    ),
)

# Dependency (foreign-key) order, which is also the order the loads run in.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        SITE,
        REGION,
        ADDRESS,
        CUSTOMER,
        EMPLOYEE,
        SUPPLIER,
        TERRITORY,
        EMPLOYEE_TERRITORY,
        PRODUCT,
        ORDER,
        ORDER_DETAIL,
    )
}


def empty_state(spark, table: Table):
    return spark.createDataFrame([], table.schema)


def contract(table: Table) -> str:
    """What a published state promises, as JSON: column names, stored types and text
    widths in order, and the primary key."""
    return json.dumps({
        "columns": [{"name": c.name, "type": c.stored.simpleString(), "width": c.width} for c in table.cols],
        "pk": list(table.pk)})


def create_table_sql(table: Table, name: str | None = None, location: str | None = None) -> str:
    """``CREATE TABLE ... USING parquet`` for a target table (SNK-DDL).

    Text columns with a width become ``VARCHAR(n)``, which Spark enforces when
    writing into the table (an over-long value fails the write, as in the
    source database); keys are documented in the comment, as parquet tables
    hold no constraints."""
    cols = []
    for c in table.cols:
        typ = f"VARCHAR({c.width})" if c.width else c.stored.simpleString().upper()
        cols.append(f"  `{c.name}` {typ}")
    loc = f"\nLOCATION '{location}'" if location else ""
    pk = ", ".join(table.pk)
    return (f"CREATE TABLE IF NOT EXISTS `{name or table.name}` (\n" + ",\n".join(cols) +
            f"\n) USING parquet{loc}\nCOMMENT 'primary key ({pk})'")
