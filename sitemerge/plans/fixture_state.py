"""A prior ODS state for tests: what a load at 2024-01-01 would have left.

Rule (FIXTURES.md section 3): each table's insert arms, run against the
parents' prior states and an empty target, keep only the staging rows whose
numeric key ``n`` has ``n % 5 <> 0`` (the others are the inserts of the next
run); one tracked column is changed so the next run has updates (NULL for
``n % 11 = 0``, else `` old`` appended for ``n % 7 = 0``; order lines get
quantity + 1 for ``n % 7 = 0``); ids follow the id order of new rows.
The site table holds site 1 only.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import typed_null
from ..operators.upsert import new_with_ids
from ..session import materialize
from ..sources.targets import TABLES, empty_state
from .loads import LOADS, ORDER, Ctx, ts_literal
from .pipeline import READS, levels, with_reads

PRIOR_TS = "2024-01-01 00:00:00"

# Which column of which arm is changed in the prior state.
PERTURBED = {
    "region": {"region": "description"},
    "address": {"address_a": "city"},
    "customer": {"customer_1": "company_name", "customer_2": "company_name"},
    "employee": {"employee_1": "first_name", "employee_2": "first_name"},
    "supplier": {"supplier_1": "company_name", "supplier_2": "company_name"},
    "territory": {"territory": "description"},
    "product": {"product_1": "name", "product_2": "name"},
    "order": {"order_1": "order_number", "order_2": "ship_via"},
    "order_detail": {"order_detail_1": "quantity_per_unit", "order_detail_2": "quantity_per_unit"},
}


def _perturb(name: str, col: str) -> Column:
    n = F.col("_n")
    if name == "order_detail":
        return F.when(n % 7 == 0, F.col(col) + 1).otherwise(F.col(col))
    return (
        F.when(n % 11 == 0, typed_null("string"))
        .when(n % 7 == 0, F.concat(F.col(col), F.lit(" old")))
        .otherwise(F.col(col))
    )


def prior_arms(ctx: Ctx, name: str) -> list[DataFrame]:
    out = []
    for arm in LOADS[name].arms:
        rows = arm.build(ctx, None)
        keep = F.col("_n") == 1 if name == "site" else F.col("_n") % 5 != 0
        rows = rows.where(keep)
        col = PERTURBED.get(name, {}).get(arm.name)
        if col:
            rows = rows.withColumn(col, _perturb(name, col))
        if "last_update" in rows.columns:
            rows = rows.withColumn("last_update", typed_null("timestamp_ntz"))
        out.append(rows.drop("_n"))
    return out


class PriorStates(Mapping):
    """The eleven prior tables, each built with those it reads when it is first asked
    for (independent tables of a level from driver threads at once)."""

    def __init__(self, spark: SparkSession, staging: dict[str, DataFrame]):
        self.spark, self.staging = spark, staging
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        return self.of([name])[name]

    def __iter__(self) -> Iterator[str]:
        return iter(ORDER)

    def __len__(self) -> int:
        return len(ORDER)

    def of(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Some prior tables."""
        names = list(names)
        with self._lock:
            for level in levels([n for n in with_reads(names) if n not in self._built]):
                with ThreadPoolExecutor(max_workers=len(level)) as pool:
                    futures = {n: pool.submit(self._one, n) for n in level}
                    self._built.update({n: f.result() for n, f in futures.items()})
            return {n: self._built[n] for n in names}

    def _one(self, name: str) -> DataFrame:
        ctx = Ctx(self.spark, self.staging, {p: self._built[p] for p in READS[name]}, ts_literal(PRIOR_TS))
        table = TABLES[name]
        rows = new_with_ids(empty_state(self.spark, table), prior_arms(ctx, name), table, start=0)
        # with an id the rows are written already (KEY-ID)
        return rows if table.id_col else materialize(rows, f"prior-{name}")
