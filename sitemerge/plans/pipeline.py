"""LOAD-* and PIPE-ALL: run the loads of :mod:`sitemerge.plans.loads`.

A load is one lazily built DataFrame plan (updates, then the insert) except
for two small driver round trips of KEY-ID (the current maximum id and the
per-partition counts).  The pipeline runs the eleven loads in foreign-key
order and publishes each table's new state before the next load reads it:
written as a parquet snapshot under a new directory per run (a job never
overwrites the files it reads), or, without a snapshot folder, as parquet
under the cluster's checkpoint folder.  Either way the lineage is cut per load
and a lost executor only recomputes from the last published state.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import apply_update, new_with_ids, to_target
from ..session import ensure_checkpoint_dir, materialize
from ..sources.targets import TABLES, empty_state
from .loads import DEFAULT_LOAD_TS, LOADS, ORDER, Ctx, Options, ts_literal

# Columns an insert arm matches on, per table; when an update of the same
# load tracks one of them the arms must see the updated state.
_ANTI_KEYS = {"address": {"orig_address_id", "full_address", "country"}}

# Target columns each load's updates set (fixed by the statements).
TRACKED = {
    "site": set(),
    "region": {"description"},
    "address": {"full_address", "city", "state", "postal_code"},
    "customer": {"company_name", "contact_name", "contact_job_title", "phone"},
    "employee": {"first_name", "last_name", "job_title", "birth_date", "hire_date",
                 "termination_date", "phone", "email", "reports_to", "notes"},
    "supplier": {"company_name", "contact_name", "contact_job_title", "phone", "website"},
    "territory": {"description"},
    "employee_territory": set(),
    "product": {"name", "category_name", "category_description", "color", "size",
                "quantity_per_unit", "unit_price", "wholesale_price", "units_in_stock",
                "units_on_order", "reorder_level", "target_stock_level", "bin_location",
                "discontinued"},
    "order": {"order_date", "ship_date", "order_number", "required_date", "ship_via",
              "shipping_company_phone", "freight"},
    "order_detail": {"quantity_per_unit", "unit_price", "tax_rate", "item_picked_date",
                     "discount"},
}


def run_updates(ctx: Ctx, name: str, upto: int | None = None) -> DataFrame:
    table = TABLES[name]
    state = ctx.state[name]
    if name in ctx.empty:  # nothing to update
        return state
    for build in LOADS[name].updates[:upto]:
        state = apply_update(state, build(ctx), table, ctx.load_ts)
    return state


def _tracked(name: str) -> set[str]:
    return TRACKED[name]


def matches_changed_columns(name: str) -> bool:
    """Whether an arm of the load matches on a column its updates set."""
    return bool(_tracked(name) & _ANTI_KEYS.get(name, {TABLES[name].orig_col}))


def _anti_target(ctx: Ctx, name: str, updated: DataFrame) -> DataFrame | None:
    if name in ctx.empty:  # every row is new
        return None
    return updated if matches_changed_columns(name) else ctx.state[name]


def arm_rows(ctx: Ctx, name: str, arm: str) -> DataFrame:
    """One insert arm's new rows (``SELECT DISTINCT`` of the arm), cast to
    the target types, without ids."""
    table = TABLES[name]
    target = _anti_target(ctx, name, run_updates(ctx, name))
    build = next(a.build for a in LOADS[name].arms if a.name == arm)
    rows = build(ctx, target).select(*table.insert_cols).distinct()
    return to_target(rows, table, table.insert_cols)


def run_load(ctx: Ctx, name: str) -> DataFrame:
    """The table's state after its whole load."""
    updated = run_updates(ctx, name)
    target = _anti_target(ctx, name, updated)
    arms = [a.build(ctx, target).drop("_n") for a in LOADS[name].arms]
    start = 0 if name in ctx.empty else None
    return updated.unionByName(new_with_ids(updated, arms, TABLES[name], start=start))


def publish(df: DataFrame, name: str, snapshot_dir: str | None, run_id: str,
            buckets: int | None = None) -> DataFrame:
    """Materialise a new table state and return a DataFrame reading it.

    With ``buckets`` a table with a source key is written bucketed (and
    sorted) by that key, as an external catalog table over the snapshot
    folder: the next run's update join and anti-join on the key then read it
    already partitioned, and only the (small) staging side is shuffled."""
    table = TABLES[name]
    # text addresses have no source key: hashed, they would all share a bucket
    if buckets and table.orig_col and name != "address":
        spark = df.sparkSession
        base = (os.path.join(snapshot_dir, name) if snapshot_dir
                else f"{ensure_checkpoint_dir(spark).rstrip('/')}/sitemerge/state-{name}")
        tag = run_id or uuid.uuid4().hex[:12]
        path = f"{base.rstrip('/')}/run={tag}"
        catalog_name = f"sitemerge_{name}_{tag}_{uuid.uuid4().hex[:6]}"
        (df.repartition(buckets, table.orig_col)
         .write.mode("errorifexists").option("path", path)
         .bucketBy(buckets, table.orig_col).sortBy(table.orig_col)
         .saveAsTable(catalog_name))
        return spark.table(catalog_name)
    if snapshot_dir:
        path = os.path.join(snapshot_dir, name, f"run={run_id}")
        df.write.mode("errorifexists").parquet(path)
        return df.sparkSession.read.schema(table.schema).parquet(path)
    return materialize(df, f"state-{name}")


# ODS tables each load reads besides its own (lookups and gates).  Every load
# reads only tables loaded before it, so loads of one level below can run at
# the same time and still see exactly the states the serial order gives them.
READS = {
    "site": [],
    "region": [],
    "address": [],
    "customer": ["address"],
    "employee": ["address"],
    "supplier": ["address"],
    "territory": ["region"],
    "employee_territory": ["employee", "territory"],
    "product": ["supplier"],
    "order": ["customer", "employee", "address"],
    "order_detail": ["order", "product"],
}


def with_reads(names: Iterable[str]) -> list[str]:
    """Some tables and all those that their loads read, directly or not, in load order."""
    needed, stack = set(), list(names)
    while stack:
        t = stack.pop()
        if t not in needed:
            needed.add(t)
            stack.extend(READS[t])
    return [t for t in ORDER if t in needed]


def levels(tables: list[str]) -> list[list[str]]:
    """The loads grouped into levels: each level reads only earlier levels."""
    depth: dict[str, int] = {}
    for name in ORDER:
        depth[name] = 1 + max((depth[p] for p in READS[name]), default=-1)
    out: dict[int, list[str]] = {}
    for name in tables:
        out.setdefault(depth[name], []).append(name)
    return [out[d] for d in sorted(out)]


def now() -> str:
    """The current time as a load stamp (UTC, seconds)."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def run_pipeline(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    state: dict[str, DataFrame] | None = None,
    load_ts: str | None = None,
    options: Options | None = None,
    snapshot_dir: str | None = None,
    tables: list[str] | None = None,
    run_id: str | None = None,
    parallel: bool = True,
) -> dict[str, DataFrame]:
    """PIPE-ALL: the loads in foreign-key order; returns the new state of
    every table.  ``load_ts`` stamps the rows; by default the current time.

    With ``parallel`` the independent loads of one level (e.g. customer,
    employee, supplier and territory) are submitted from driver threads at
    once, so small dimension loads overlap instead of queueing; the results
    equal the serial order.  With ``snapshot_dir`` each loaded table's new
    state is written to ``<snapshot_dir>/<table>/run=<run_id>``."""
    run_id = run_id or uuid.uuid4().hex[:12]
    load_ts = load_ts or now()
    state = dict(state or {})
    empty = set()
    for name in ORDER:
        if name not in state:
            state[name] = empty_state(spark, TABLES[name])
            empty.add(name)
    todo = [n for n in ORDER if n in (tables or ORDER)]

    def one(name: str, frozen_state: dict, frozen_empty: frozenset) -> DataFrame:
        ctx = Ctx(spark, staging, frozen_state, ts_literal(load_ts), options or Options(),
                  frozen_empty)
        return publish(run_load(ctx, name), name, snapshot_dir, run_id,
                       (options or Options()).buckets)

    for level in (levels(todo) if parallel else [[n] for n in todo]):
        frozen_state, frozen_empty = dict(state), frozenset(empty)
        if len(level) == 1:
            results = {level[0]: one(level[0], frozen_state, frozen_empty)}
        else:
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                futures = {n: pool.submit(one, n, frozen_state, frozen_empty) for n in level}
                results = {n: f.result() for n, f in futures.items()}
        state.update(results)
        empty.difference_update(results)
    return state


def pipeline_counts(state_before: dict[str, DataFrame], state_after: dict[str, DataFrame],
                    load_ts: str = DEFAULT_LOAD_TS) -> DataFrame:
    """Rows per table after a run, with how many were inserted and updated."""
    ts = ts_literal(load_ts)
    parts = []
    for name in ORDER:
        after = state_after[name]
        has_update = "last_update" in after.columns
        parts.append(
            after.agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(F.when(F.col("date_created") == ts, 1).otherwise(0)).alias("inserted"),
                (F.sum(F.when(F.col("last_update") == ts, 1).otherwise(0)) if has_update
                 else F.lit(0)).alias("updated"),
            ).select(F.lit(name).alias("table_name"), "rows", "inserted", "updated")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        "table_name",
        F.col("rows").cast("long").alias("rows"),
        F.coalesce(F.col("inserted"), F.lit(0)).cast("long").alias("inserted"),
        F.coalesce(F.col("updated"), F.lit(0)).cast("long").alias("updated"),
    )
